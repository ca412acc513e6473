"""Benchmark decontamination by winnowing.

Words are hashed; every run of ``GRAM`` words gets a hash, and of each ``window - GRAM + 1``
consecutive runs the one with the smallest hash (the last of several) is a fingerprint.  A
``window`` of words that a document shares with an item selects the same fingerprint at the same
place on both sides, so a join of fingerprints finds every shared window.  Each joined pair is then
extended word by word in both directions, at most to the ends of the windows that hold the
fingerprint, and counts where the common run is at least a window long.  Words are compared as
text, so equal hashes of different words do no harm.  An item of fewer words than a window is one
run of its own length, found by the hashes of all document runs of that length.

Fingerprints of documents pass a bitmap of the items' fingerprints before they are shuffled.  The
bitmap has a fixed size (``filter_bits``); a larger benchmark makes it let more through and changes
no result.  A hot passage gives one row for each document that has it, and documents are salted
against the item's rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import textkit
from tidemark.llm.scratch import free, small_batches

GRAM = 5
SALTS = 8

_CANDIDATE = ("id {id}, digest long, n_words long, kind int, hash long, salt int, core string, "
              "left array<string>, right array<string>, places array<long>")


def _fingerprints(hashes, first, window):
    """``(row, place)`` of the fingerprints of a slice; places count words of the slice."""
    g = textkit.grams(hashes, GRAM)
    row, ok = textkit.gram_rows(first, window, len(hashes) - window + 1)
    span = window - GRAM + 1
    count = len(row)
    if not count:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), g
    best, at = g[:count].copy(), np.zeros(count, np.int8)
    for j in range(1, span):
        other = g[j:j + count]
        smaller = other <= best
        best[smaller], at[smaller] = other[smaller], j
    place = (np.arange(count) + at)[ok]
    keep = np.ones(len(place), bool)
    keep[1:] = place[1:] != place[:-1]
    return row[ok][keep], place[keep], g


def _contexts(buf, starts, ends, low, high, place, size, reach):
    """Words around the run of ``size`` words at ``place``, within the row's words low to high."""
    def text(i, j):
        return [buf[starts[k]:ends[k]].tobytes().decode("utf-8", "replace") for k in range(i, j)]

    left = text(max(low, place - reach), place)[::-1]
    right = text(place + size, min(high, place + size + reach))
    return " ".join(text(place, place + size)), left, right


def _scan(batches, id_type, window, lengths, bitmap, items):
    """Rows for the join; of documents also one row each that carries the number of words.

    ``bitmap`` is None for the items themselves, which emit everything.
    """
    import xxhash

    bits = None if bitmap is None else np.frombuffer(bitmap, np.uint8)
    reach = window - GRAM
    for batch in batches:
        ids, texts = textkit.column(batch, "id"), textkit.column(batch, "text")
        for at, rows, buf, bounds in textkit.slices(texts):
            buf = textkit.LOWER[buf]
            starts, ends, first = textkit.words(buf, bounds, textkit.ALNUM)
            hashes = textkit.word_hashes(buf, starts, ends)
            sizes = np.diff(first)
            found = []  # (row, place, size, hash)
            row, place, g = _fingerprints(hashes, first, window)
            if not items:
                found.append((row, place, GRAM, g[place]))
                for n in lengths:
                    g = textkit.grams(hashes, n)
                    row, ok = textkit.gram_rows(first, n, len(g))
                    found.append((row[ok], np.flatnonzero(ok), n, g[ok]))
            else:
                long = sizes[row] >= window
                found.append((row[long], place[long], GRAM, g[place][long]))
                for n in range(1, window):
                    short = np.flatnonzero(sizes == n)
                    found.append((short, first[:-1][short], n, textkit.grams(hashes, n)[first[:-1][short]]
                                  if len(short) else np.zeros(0, np.uint64)))
            out = {name: [] for name in ("row", "kind", "hash", "core", "left", "right", "places")}
            for (row, place, size, hash_), kind in zip(found, [0, *(lengths if not items else range(1, window))]):
                if bits is not None:
                    slot = hash_ & np.uint64(len(bits) * 8 - 1)
                    hit = (bits[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 > 0
                    row, place, hash_ = row[hit], place[hit], hash_[hit]
                together = {}
                for r, p, h in zip(row.tolist(), place.tolist(), hash_.view(np.int64).tolist()):
                    core, left, right = _contexts(buf, starts, ends, first[r], first[r + 1], p, size,
                                                  reach if kind == 0 else 0)
                    key = (r, h, core, tuple(left), tuple(right))
                    together.setdefault(key, []).append(p - int(first[r]))
                for (r, h, core, left, right), places in together.items():
                    for name, value in zip(out, (r, kind, h, core, left, right, places)):
                        out[name].append(value)
            n = len(out["row"])
            heads = 0 if items else rows
            order = np.concatenate([np.asarray(out["row"], np.int64), np.arange(heads)])
            digests = np.array([xxhash.xxh3_64_intdigest(buf[bounds[r]:bounds[r + 1]]) for r in range(rows)],
                               np.uint64).view(np.int64)
            digest = digests[order]
            yield pa.RecordBatch.from_arrays([
                ids.slice(at, rows).take(pa.array(order)),
                pa.array(digest),
                pa.array(np.concatenate([np.full(n, -1), sizes[:heads]]), pa.int64()),
                pa.array(out["kind"] + [-1] * heads, pa.int32()),
                pa.array(np.concatenate([np.asarray(out["hash"], np.int64), digests[:heads]])),
                pa.array(digest % SALTS, pa.int32()),
                pa.array(out["core"] + [None] * heads, pa.string()),
                pa.array(out["left"] + [None] * heads, pa.list_(pa.string())),
                pa.array(out["right"] + [None] * heads, pa.list_(pa.string())),
                pa.array(out["places"] + [None] * heads, pa.list_(pa.int64())),
            ], names=["id", "digest", "n_words", "kind", "hash", "salt", "core", "left", "right", "places"])


def _candidates(df, id_col, text_col, window, lengths, bitmap, items):
    given = small_batches(df).select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    id_type = given.schema["id"].dataType.simpleString()
    held = df.sparkSession.sparkContext.broadcast(bitmap) if bitmap is not None else None

    def scan(batches):
        return _scan(batches, id_type, window, lengths, held.value if held else None, items)

    return given.mapInArrow(scan, _CANDIDATE.format(id=id_type))


def _bitmap(prints: DataFrame, bits: int) -> tuple[bytes, list[int]]:
    """The items' fingerprints as a bitmap of fixed size, and the lengths of short items (under a window)."""
    slot = F.col("hash").bitwiseAND(F.lit((1 << bits) - 1))
    words = prints.groupBy(F.shiftright(slot, 5).alias("at")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), slot.bitwiseAND(F.lit(31)).cast("int")))
        .alias("flags")).toArrow()
    table = np.zeros(1 << (bits - 5), np.uint32)
    table[words["at"].to_numpy()] = words["flags"].to_numpy().astype(np.uint32)
    lengths = [r[0] for r in prints.filter("kind > 0").select("kind").distinct().collect()]
    return table.tobytes(), sorted(lengths)


def contaminated_spans(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id",
                       text: str = "text", window: int = 10, filter_bits: int = 22) -> DataFrame:
    """Per document the spans that it shares with items.

    Returns ``doc_id, digest, copies, n_words, spans, items``: one row per different
    (id, text), with ``copies`` the number of equal rows, ``spans`` the merged hit spans (word
    numbers, end exclusive) and ``items`` the ids of items with a window in the document.  Null texts
    have no words; null ids are kept; an empty table on either side gives no hits.  Items and
    documents may have any other columns.
    """
    if window <= GRAM:
        raise ValueError(f"window must be over {GRAM} words")
    prints = _candidates(items, item_id, text, window, [], None, True)
    bitmap, lengths = _bitmap(prints, filter_bits)
    found = _candidates(docs, doc_id, text, window, lengths, bitmap, False)
    theirs = prints.select(
        F.col("id").alias("item"), "kind", "hash", "core", F.col("left").alias("item_left"),
        F.col("right").alias("item_right"),
        F.explode(F.array(*[F.lit(s) for s in range(SALTS)])).alias("salt")).distinct()
    joined = found.join(theirs, ["kind", "hash", "salt", "core"], "left")

    def common(mine, other):
        differs = F.array_position(F.zip_with(mine, other, lambda a, b: ~F.coalesce(a == b, F.lit(False))),
                                   F.lit(True))
        return F.when(differs == 0, F.size(mine)).otherwise(differs.cast("int") - 1)

    size = F.when(F.col("kind") == 0, F.lit(GRAM)).otherwise(F.col("kind"))
    least = F.when(F.col("kind") == 0, F.lit(window)).otherwise(F.col("kind"))
    runs = joined.withColumn("before", common(F.col("left"), F.col("item_left"))) \
        .withColumn("after", common(F.col("right"), F.col("item_right"))) \
        .withColumn("hit", F.col("item_right").isNotNull() & (F.col("before") + size + F.col("after") >= least)) \
        .select("id", "digest", "n_words", "hit", "item",
                F.when(F.col("hit"), F.transform("places", lambda p: F.struct(
                    (p - F.col("before")).alias("start"), (p + size + F.col("after")).alias("end")))).alias("runs"))
    # spans of one document: distinct per map task first, so a passage that many items hold arrives once
    per_doc = runs.groupBy("id", "digest").agg(
        F.sum((F.col("n_words") >= 0).cast("long")).alias("copies"),
        F.max("n_words").alias("n_words"),
        F.array_sort(F.flatten(F.collect_set("runs"))).alias("all_runs"),
        F.array_sort(F.collect_set(F.when(F.col("hit"), F.col("item")))).alias("items"))
    merged = F.aggregate(
        F.col("all_runs"), F.array().cast("array<struct<start:bigint,end:bigint>>"),
        lambda acc, r: F.when(
            (F.size(acc) > 0) & (F.element_at(acc, -1)["end"] >= r["start"]),
            F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(
                F.element_at(acc, -1)["start"].alias("start"),
                F.greatest(F.element_at(acc, -1)["end"], r["end"]).alias("end")))))
        .otherwise(F.concat(acc, F.array(r))))
    return per_doc.select(F.col("id").alias(doc_id), "digest", "copies", "n_words",
                          F.when(F.size("all_runs") > 0, merged).otherwise(
                              F.array().cast("array<struct<start:bigint,end:bigint>>")).alias("spans"), "items")


def contamination(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """One row per document row: the id, ``n_words, n_hit, n_items, items, contaminated``."""
    doc_id = options.get("doc_id", "doc_id")
    spans = contaminated_spans(docs, items, **options)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + s["end"] - s["start"])
    return spans.withColumn("n_hit", hit).select(
        doc_id, "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items",
        (F.col("n_hit") > 0).alias("contaminated"),
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("_copy")).drop("_copy")


def drop_contaminated(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
                      **options) -> DataFrame:
    """The documents without a window of any item, with all their columns, which may have any names.

    Rows are judged by id and text, so rows without an id, or that share one, are judged each by itself.
    """
    key = free("_key", docs)
    whole = F.col(text).cast("string")
    marked = docs.withColumn(key, F.struct(F.col(doc_id).alias("id"), F.xxhash64(whole).alias("a"),
                                           F.xxhash64(F.lit(1), whole).alias("b")))
    bad = contamination(marked.select(key, text), items, doc_id=key, text=text, **options).filter("contaminated") \
        .select(key).distinct()
    return marked.join(bad, key, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
