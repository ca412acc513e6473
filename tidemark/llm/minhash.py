"""MinHash near-duplicates by an exact Hamming join of b-bit signatures.

A document's signature has K values of 16 bits: the low bits of the smallest shingle under each of K
hash functions.  Two sets of Jaccard j differ in each value with a probability of at most 1 - j.  The
join finds *all* pairs of signatures that differ in at most D values; K and D are chosen so that a
pair right at the wanted Jaccard differs in more than D values with a probability below ``MISS``,
and far less often above it.

The signature is cut into m chunks.  By the pigeonhole principle a pair within D has a chunk with few
errors: with D = r m + s, at most r in one of the first s + 1 chunks or at most r - 1 in another one.
For every chunk all places of that many errors are enumerated: each leaves a key of the other values,
on which the pair agrees.  Chunks have four values and one error, so a key holds three values, 48 bits,
and the number of its pattern.

Equal sets are one class first, so copies are never compared.  A third of all documents may be near
copies of each other and share keys, so not all pairs of a key are made: first every class of a key
is compared with the key's smallest and largest class; pairs within D are confirmed on the whole sets
and linked to components.  Of the keys whose classes are still apart, those with the same classes are one.  Their
classes meet a few more that are drawn by hash.  Then classes of a key in different components meet, those
outside its largest one with all others, in a join that emits only pairs whose sets' parity bitmaps, folded and
whole, differ in no more places than linked sets can (an exact filter: hundreds of variants just below the
threshold may share their keys); of those the distance is compared.
A link inside a component could not change it.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import textkit
from tidemark.llm.components import connected, drawn_pairs, labelled, pairs_across, still_apart
from tidemark.llm.scratch import Scratch, small_batches
from tidemark.llm.shingles import FOLDS, bitmap, folds, folds_alike, maps_alike, slice_sets, verified

CHUNK = 4         # values of a chunk
MISS = 1e-9       # of pairs right at the threshold
HASHED = 1 << 18  # shingles hashed at once


def beyond(k: int, d: int, differ: float) -> float:
    """Probability that more than ``d`` of ``k`` values differ."""
    return sum(comb(k, i) * differ ** i * (1 - differ) ** (k - i) for i in range(d + 1, k + 1))


def plan(percent: int) -> tuple[int, int]:
    """``(values, distance)``: the shortest signature whose chunks need one error at most."""
    differ = 1 - percent / 100
    for chunks in range(2, 64):
        k = CHUNK * chunks
        d = next(d for d in range(k + 1) if beyond(k, d, differ) < MISS)
        if d < 2 * chunks:
            return k, d
    raise ValueError("the similarity is too low for chunks of this size")


def patterns(values: int, distance: int) -> list[tuple[int, ...]]:
    """Places of the values that each key keeps: chunk by chunk, all places of the allowed errors."""
    chunks = values // CHUNK
    errors, spare = divmod(distance, chunks)
    out = []
    for c in range(chunks):
        allowed = errors if c <= spare else errors - 1
        if allowed >= 0:
            out += [tuple(CHUNK * c + i for i in keep) for keep in combinations(range(CHUNK), CHUNK - allowed)]
    return out


def _seeds(values: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240711)
    return (rng.integers(0, 1 << 63, values, dtype=np.uint64),
            rng.integers(0, 1 << 63, values, dtype=np.uint64) * np.uint64(2) + np.uint64(1))


def minima(value: np.ndarray, edges: np.ndarray, values: int) -> np.ndarray:
    """Low 16 bits of the smallest hash of each non-empty run of shingles, one column per hash function."""
    out = np.empty((len(edges) - 1, values), np.uint64)
    flips, factors = _seeds(values)
    row = 0
    while row < len(edges) - 1:
        to = max(row + 1, int(np.searchsorted(edges, edges[row] + HASHED, "right")) - 1)
        part, starts = value[edges[row]:edges[to]], edges[row:to] - edges[row]
        for k in range(values):
            out[row:to, k] = np.minimum.reduceat((part ^ flips[k]) * factors[k], starts)
        row = to
    # a minimum's high bits are nearly all zero; its low bits tell one shingle from another
    return (textkit.mix(out) & np.uint64(0xFFFF)).astype(np.uint16)


def signatures(given: DataFrame, n: int, values: int) -> DataFrame:
    """Per row of ``id, text``: ``id, size, digest, signature, bitmap``."""
    kind = given.schema["id"].dataType.simpleString()

    def run(batches):
        import xxhash

        for batch in batches:
            for at, rows, buf, bounds in textkit.slices(batch.column(1)):
                row, value = slice_sets(buf, bounds, n)
                edges = np.searchsorted(row, np.arange(rows + 1))
                full = np.flatnonzero(np.diff(edges))
                low = iter(minima(value, np.append(edges[full], len(value)), values)) if len(full) else iter(())
                digest, signature, bitmaps = [], [], []
                for i, j in zip(edges[:-1], edges[1:]):
                    digest.append(xxhash.xxh3_128_digest(value[i:j]))
                    signature.append(next(low).tobytes() if j > i else None)
                    bitmaps.append(bitmap(value[i:j]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, rows), pa.array(np.diff(edges), pa.int64()),
                     pa.array(digest, pa.binary()), pa.array(signature, pa.binary()),
                     pa.array(bitmaps, pa.list_(pa.int64()))],
                    names=["id", "size", "digest", "signature", "bitmap"])

    return given.mapInArrow(run, f"id {kind}, size long, digest binary, signature binary, bitmap array<long>")


def keys(classes: DataFrame, values: int, distance: int) -> DataFrame:
    """``id, key`` of every class ``id, signature``: the kept values of each pattern, and its number."""
    kind = classes.schema["id"].dataType.simpleString()
    kept = patterns(values, distance)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            table = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16).reshape(-1, values)
            table = table.astype(np.uint64)
            out = np.empty((len(table), len(kept)), np.uint64)
            for i, places in enumerate(kept):
                key = np.full(len(table), i, np.uint64)
                for p in places:
                    key = (key << np.uint64(16)) | table[:, p] if len(places) < CHUNK else textkit.mix(
                        key * textkit.ODD + table[:, p])
                out[:, i] = key
            at = np.repeat(np.arange(len(table)), len(kept))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at)), pa.array(out.reshape(-1).view(np.int64))], names=["id", "key"])

    return classes.select("id", "signature").mapInArrow(run, f"id {kind}, key long")


def _near(values: int, distance: int, percent: int):
    """``x`` and ``y`` (size, signature, bitmap) within the distance, and of sets that can be linked."""
    differ = F.lit(0)
    for i in range(values):
        differ = differ + (F.substring("x.signature", 2 * i + 1, 2) != F.substring("y.signature", 2 * i + 1, 2)).cast("int")
    return folds_alike(percent) & (differ <= distance) & maps_alike(percent)


def _near_pairs(pairs: DataFrame, marks: DataFrame, values: int, distance: int, percent: int) -> DataFrame:
    """The pairs ``a, b`` within the distance."""
    return pairs.join(marks.alias("x"), F.col("a") == F.col("x.id")).join(
        marks.alias("y"), F.col("b") == F.col("y.id")).filter(_near(values, distance, percent)).select("a", "b")


def near_duplicates(docs: DataFrame, n: int = 5, percent: int = 80, doc_id: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """One row per document row: the id, ``n_shingles`` and ``component_id``.

    Documents link when their sets of ``n``-word shingles have an intersection of at least ``percent``
    hundredths of the union, confirmed on whole sets; the component is the smallest id reachable.
    A text of fewer than ``n`` words is one shingle; a null text or one without words has none and is
    its own component.  Rows of one id are judged by their texts.  A row without an id has the
    component of its equals, if one of them has an id, else null.  Only the two named columns are
    read, so other columns may have any name.  An empty table gives an empty result.
    """
    held = Scratch(docs.sparkSession)
    values, distance = plan(percent)
    given = small_batches(docs).select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text"))
    signed = held.written(signatures(given, n, values), "signatures")
    classes = held.written(signed.filter("size > 0").groupBy("digest").agg(
        F.min("id").alias("id"), *[F.first(c).alias(c) for c in ("size", "signature", "bitmap")]), "classes")
    rows = held.written(signed.select("id", "size", "digest"), "rows")
    held.drop("signatures")
    # a set that is too small has no linked set but itself
    open_ = classes.filter(f"id IS NOT NULL AND {percent} * (size + 1) <= 100 * size")
    entries = held.written(keys(open_, values, distance), "keys")
    shared = entries.groupBy("key").agg(F.min("id").alias("low"), F.max("id").alias("high")).filter("low <> high")
    shared = held.written(entries.join(shared, "key"), "shared")
    held.drop("keys")
    pivots = shared.select(F.col("low").alias("a"), F.col("id").alias("b")).union(
        shared.select(F.col("id").alias("a"), F.col("high").alias("b"))).filter("a <> b").distinct()
    marks = open_.join(shared.select("id").distinct(), "id", "left_semi")
    marks = held.written(marks.select("id", "size", "signature", "bitmap", *folds()), "marks")
    near = _near_pairs(pivots, marks, values, distance, percent)
    links = verified(near, given, n, percent, "links", held)
    # what shares a key and is not in one component yet: to a few drawn classes of each key, then all others
    columns = ("size", *FOLDS)
    known = labelled(marks, connected(links), *columns)
    open_ = held.written(still_apart(shared, known), "open")
    held.drop("shared")
    drawn = drawn_pairs(open_.join(known, "id"), folds_alike(percent))
    near = _near_pairs(drawn, marks, values, distance, percent)
    links = links.union(verified(near, given, n, percent, "again", held))
    known = labelled(marks, connected(links), *columns, "bitmap")
    rest = held.written(still_apart(open_, known).join(known, "id"), "rest")
    held.drop("open")
    more = held.written(pairs_across(rest, folds_alike(percent) & maps_alike(percent)), "across")
    more = _near_pairs(more, marks, values, distance, percent)
    more = verified(more, given, n, percent, "more", held)
    held.drop("rest", "across", "marks")
    found = connected(links.union(more)).select(F.col("node").alias("id"), "label")
    ids = held.written(classes.select("digest", "id").join(found, "id", "left").select(
        "digest", F.coalesce("label", "id").alias("component_id")), "components")
    held.drop("classes", "links", "again", "more")
    return rows.join(ids, "digest", "left").select(
        F.col("id").alias(doc_id), F.col("size").alias("n_shingles"),
        F.when(F.col("size") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"))
