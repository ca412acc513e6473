"""Exact Jaccard join of word n-gram sets with token-combination prefixes.

Every document is the set of its distinct shingles.  Equal sets become one class first, by a digest
of the set, so copies are never compared.  For the classes:

* Shingles get a global order: frequent ones last, by a hash otherwise.  Frequency comes from
  ``1 << SKETCH_BITS`` counters over all documents; an inaccurate counter changes the order, which
  costs time and never a result.
* Two sets of at least t Jaccard share ``l`` shingles among the first ``n - ceil(t n) + l`` of each,
  the prefix extended by ``l - 1``.
* Keys of a class are each rare shingle of its extended prefix, alone, and combinations of two
  frequent ones.  To keep those few, frequent shingles are dealt into G groups by hash and combined
  within a group, and the prefix is extended to ``l = G + 1``: linked sets share a rare shingle
  there, or else G + 1 frequent ones, two of them in one group.  G goes by size class, and a set
  gives keys for every size class that a set linked to it can have.

Classes that share a key are candidates.  A third of all documents may be near copies of each other
and share keys, so not all pairs of a key are made.  First every class of a key is compared with
the key's smallest and largest class; links are verified on the whole sets and merged to components.
Of the keys whose classes are not yet in one component, those with the same classes are one from there on.
Their classes meet a few more that are drawn by hash.  Then only classes of a key in different components are
compared, those outside its largest one with all others.  A pair leaves its key only if it passes filters that no
linked pair fails: sizes, and the bits of each set's parity bitmap, whose difference is at most the difference of the
sets.  The bitmap has a place for each shingle at least, so it tells large sets apart as well as small ones.  A link
inside a component could not change it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from tidemark.llm import textkit
from tidemark.llm.components import connected, drawn_pairs, labelled, pairs_across, still_apart
from tidemark.llm.scratch import Scratch, free, small_batches
from tidemark.llm.shingles import FOLDS, bitmap, folds, folds_alike, maps_alike, slice_sets, verified

SKETCH_BITS = 21
SKETCH_PARTS = 64
PER_GROUP = 8    # frequent shingles of a prefix that a group holds, about


def _counter(value: np.ndarray) -> np.ndarray:
    return (value >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def frequencies(given: DataFrame, n: int) -> np.ndarray:
    """Logarithm of each counter over the ordinary level, as a small number; 0 is rare."""
    width = (1 << SKETCH_BITS) // SKETCH_PARTS

    def count(batches):
        total, held, size = np.zeros(1 << SKETCH_BITS, np.int64), [], 0
        for batch in batches:
            for _, _, buf, bounds in textkit.slices(batch.column(0)):
                held.append(_counter(slice_sets(buf, bounds, n)[1]))
                size += len(held[-1])
                if size > len(total):
                    total += np.bincount(np.concatenate(held), minlength=len(total))
                    held, size = [], 0
        if held:
            total += np.bincount(np.concatenate(held), minlength=len(total))
        for i, part in enumerate(np.split(total, SKETCH_PARTS)):
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array(
                [pa.compress(part.astype("<i8").tobytes(), "zstd", asbytes=True)], pa.binary())],
                names=["part", "counts"])

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(width, np.int64)
        for x in table["counts"].to_pylist():
            total += np.frombuffer(pa.decompress(x, width * 8, "zstd", asbytes=True), "<i8")
        return pa.table({"part": table["part"].slice(0, 1), "counts": pa.array([total.tobytes()], pa.binary())})

    # a table of fixed size, whatever the number of documents
    got = given.select("text").mapInArrow(count, "part int, counts binary").groupBy("part").applyInArrow(
        add, "part int, counts binary").collect()
    total = np.zeros(1 << SKETCH_BITS, np.int64)
    for r in got:
        total[r["part"] * width:(r["part"] + 1) * width] = np.frombuffer(r["counts"], "<i8")
    # counters hold many rare shingles each; only what stands out from that counts as frequent
    level = np.median(total)
    over = total - (level + 6 * np.sqrt(level) + 8)
    return np.where(over > 0, 1 + np.log2(np.maximum(over, 1)), 0).astype(np.uint8)


def prefix_size(size: int, percent: int) -> int:
    """Shingles of a set of which a linked set has one in its own prefix."""
    return size - -(-percent * size // 100) + 1


def _class_of(size: int) -> int:
    return int(size).bit_length()


def _keys(value: np.ndarray, frequent: np.ndarray, percent: int) -> np.ndarray:
    """Keys of one set; none if it is too small to be linked with a different one."""
    size = len(value)
    if percent * (size + 1) > 100 * size:
        return np.zeros(0, np.uint64)
    order = np.lexsort((textkit.mix(value), frequent))
    ranked, classes = value[order], frequent[order]
    plain = prefix_size(size, percent)
    out = []
    for c in range(_class_of(-(-percent * size // 100)), _class_of(100 * size // percent) + 1):
        groups = 1 + max(0, (100 - percent) * (1 << c) // 100 // PER_GROUP)
        extended = min(size, plain + groups)
        often = ranked[:extended][classes[:extended] > 0]
        out.append(ranked[:extended][classes[:extended] == 0])
        if len(often) > 1:
            salt = textkit.ODD * np.uint64(2 * c + 1)
            group = (textkit.mix(often + salt) % np.uint64(groups)).astype(np.int64)
            by = np.argsort(group, kind="stable")
            often, group = often[by], group[by]
            edges = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1], [True]]))
            for i, j in zip(edges[:-1], edges[1:]):
                low, high = np.triu_indices(j - i, 1)
                a, b = often[i:j][low], often[i:j][high]
                out.append(textkit.mix(np.minimum(a, b) * textkit.ODD + np.maximum(a, b) + salt))
    return np.unique(np.concatenate(out))


def signatures(given: DataFrame, n: int, percent: int, frequent: np.ndarray) -> DataFrame:
    """Per row ``id, size, digest, bitmap, keys``."""
    kind = given.schema["id"].dataType.simpleString()
    held = given.sparkSession.sparkContext.broadcast(frequent)

    def run(batches):
        import xxhash

        for batch in batches:
            for at, rows, buf, bounds in textkit.slices(batch.column(1)):
                row, value = slice_sets(buf, bounds, n)
                often = held.value[_counter(value)]
                edges = np.searchsorted(row, np.arange(rows + 1))
                digest, bitmaps, keys = [], [], []
                for i, j in zip(edges[:-1], edges[1:]):
                    digest.append(xxhash.xxh3_128_digest(value[i:j]))
                    bitmaps.append(bitmap(value[i:j]))
                    keys.append(_keys(value[i:j], often[i:j], percent).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, rows), pa.array(np.diff(edges), pa.int64()),
                     pa.array(digest, pa.binary()), pa.array(bitmaps, pa.list_(pa.int64())),
                     pa.array(keys, pa.list_(pa.int64()))], names=["id", "size", "digest", "bitmap", "keys"])

    return given.mapInArrow(run, f"id {kind}, size long, digest binary, bitmap array<long>, keys array<long>")


def jaccard_components(docs: DataFrame, n: int = 3, percent: int = 90, doc_id: str = "doc_id",
                       text: str = "text") -> DataFrame:
    """One row per document row: the id, ``n_shingles`` and ``component_id``.

    Documents link when their sets' intersection is at least ``percent`` hundredths of the union; the
    component is the smallest id reachable.  A text of fewer than ``n`` words is one shingle; a null
    text or one without words has none and is its own component.  Rows of one id are judged by their
    texts.  A row without an id has the component of its equals, if one of them has an id, else null.
    """
    held = Scratch(docs.sparkSession)
    given = small_batches(docs).select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text"))
    signed = held.written(signatures(given, n, percent, frequencies(given, n)), "signatures")
    rows = held.written(signed.select("id", "size", "digest"), "rows")
    classes = held.written(rows.filter("size > 0").groupBy("digest").agg(F.min("id").alias("rep")), "classes")
    # copies go before keys are dealt out
    reps = held.written(signed.filter("size(keys) > 0").join(
        classes.filter("rep IS NOT NULL").select(F.col("rep").alias("id"), "digest"), ["id", "digest"])
        .dropDuplicates(["id", "digest"]).select("id", "size", "bitmap", "keys"), "reps")
    held.drop("signatures")
    entries = reps.select("id", F.explode("keys").alias("key"))
    shared = entries.groupBy("key").agg(F.min("id").alias("low"), F.max("id").alias("high")).filter("low <> high")
    shared = held.written(entries.join(shared, "key"), "shared")
    marks = held.written(reps.join(shared.select("id").distinct(), "id", "left_semi").select(
        "id", "size", "bitmap", *folds()), "marks")
    held.drop("reps")
    # to the smallest and the largest class of each key
    pivots = shared.select(F.col("low").alias("a"), F.col("id").alias("b")).union(
        shared.select(F.col("id").alias("a"), F.col("high").alias("b"))).filter("a <> b").distinct()
    links = verified(_filtered(held.written(pivots, "pivots"), marks, percent, held), given, n, percent, "links", held)
    held.drop("pivots", "near")
    # what shares a key and is not in one component yet: to a few drawn classes of each key, then all others
    known = labelled(marks, connected(links), "size", *FOLDS)
    open_ = held.written(still_apart(shared, known), "open")
    held.drop("shared")
    drawn = held.written(drawn_pairs(open_.join(known, "id"), folds_alike(percent)), "pivots")
    links = links.union(verified(_filtered(drawn, marks, percent, held), given, n, percent, "again", held))
    held.drop("pivots", "near")
    known = labelled(marks, connected(links), "size", *FOLDS, "bitmap")
    rest = held.written(still_apart(open_, known).join(known, "id"), "rest")
    held.drop("open", "marks")
    more = verified(pairs_across(rest, folds_alike(percent) & maps_alike(percent)), given, n, percent, "more", held)
    held.drop("rest")
    found = connected(links.union(more)).select(F.col("node").alias("rep"), "label")
    ids = held.written(classes.join(found, "rep", "left").select(
        "digest", F.coalesce("label", "rep").alias("component_id")), "components")
    held.drop("classes", "links", "again", "more")
    return rows.join(ids, "digest", "left").select(
        F.col("id").alias(doc_id), F.col("size").alias("n_shingles"),
        F.when(F.col("size") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"))


def _filtered(pairs: DataFrame, marks: DataFrame, percent: int, held: Scratch) -> DataFrame:
    """Pairs that sizes and bitmaps do not rule out: the folded bitmaps first, whole ones of what they leave."""
    for columns, near in ((FOLDS, folds_alike(percent)), (("bitmap",), maps_alike(percent))):
        of = marks.select("id", "size", *columns)
        pairs = pairs.join(of.alias("x"), F.col("a") == F.col("x.id")).join(
            of.alias("y"), F.col("b") == F.col("y.id")).filter(near).select("a", "b")
        if columns is FOLDS:
            pairs = held.written(pairs, "near")
    return pairs


def one_per_component(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents that are the smallest of their component, with all their columns.

    Rows without an id take part too: they rank behind all ids, by a hash of their text.  Of rows of one
    id and text, or of one text without an id, one stays.  Rows that share an id but not a text go
    together, if one of them does.  Columns may have any names.
    """
    key, version = free("_key", docs), free("_version", docs)
    hashed = F.xxhash64(F.col(text))
    if isinstance(docs.schema[doc_id].dataType, IntegralType):
        last = hashed.bitwiseAND(F.lit((1 << 60) - 1)) + F.lit(7 << 60)  # beyond any real id
        named = F.coalesce(F.col(doc_id).cast("long"), last)
    else:
        named = F.coalesce(F.col(doc_id).cast("string"), F.concat(F.lit(chr(0x10FFFF)), hashed.cast("string")))
    marked = docs.withColumn(key, named)
    parts = jaccard_components(marked.select(key, text), doc_id=key, text=text, **options)
    gone = parts.filter(F.col(key) != F.col("component_id")).select(key).distinct()
    kept = marked.join(gone, key, "left_anti")
    # ids are unique as a rule; only else are whole rows compared
    if parts.groupBy(key).count().filter("count > 1").limit(1).count():
        kept = kept.withColumn(version, hashed).dropDuplicates([key, version])
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
