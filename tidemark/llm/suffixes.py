"""Duplicate byte strings by a difference cover of the suffixes.

A byte is removed if a string of ``length`` bytes that covers it starts anywhere else too.  Only
the first ``length`` bytes of suffixes matter, which shortens the difference-cover construction to
three distributed steps:

1. *Sampled tuples.*  Suffixes whose offset modulo V lies in a perfect difference set D are the
   sample.  For any two suffixes there is a shift below V that brings both into the sample, so two
   equal strings of ``length`` bytes hold equal tuples of ``length - V + 1`` bytes at sampled
   offsets.  Tuples are named (64 bit hashes), names are dealt into buckets, sorted, and neighbours
   compared; a tuple whose name stands alone proves the suffixes before it, up to the previous
   sampled ones, unique in the sense wanted.
2. *Names again.*  Suffixes in reach of a tuple that has an equal are named by all ``length`` bytes,
   dealt, sorted and compared in the same way, sampled and remaining ones alike: equal neighbours
   are equal prefixes.
3. The marked prefixes are merged to maximal runs, and those are cut out.

Each step handles blocks of whole texts of about ``BLOCK`` bytes, kept in the shared folder.  A block
sends each distinct name once to a bucket, however often it holds it, so a string that fills a third
of the corpus sends one name per block.  The answer is one bit per name in the order sent, and the
block finds the offsets again from its text; no offsets travel.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import textkit
from tidemark.llm.scratch import small_batches, written
from tidemark.session import scratch_dir

#: A perfect difference set: the differences of its members give every number modulo V.
V = 91
COVER = np.array([0, 1, 3, 9, 27, 49, 56, 61, 77, 81])

BLOCK = 8 << 20
#: Text bytes for which there is one bucket of names.
BUCKET_BYTES = 64 << 20


# --- blocks ------------------------------------------------------------------------

def _files(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def _store(batches, folder):
    """Write blocks of whole texts; one row ``block, n_bytes`` each."""
    held, size = [], 0

    def flush():
        name = f"{folder}/{uuid.uuid4().hex}.arrow"
        files, path = _files(name)
        files.create_dir(path.rsplit("/", 1)[0], recursive=True)
        table = pa.Table.from_batches(held)
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        with files.open_output_stream(path) as sink, pa.ipc.new_file(sink, table.schema, options=options) as out:
            out.write_table(table)
        return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([size], pa.int64())],
                                          names=["block", "n_bytes"])

    for batch in batches:
        for at, rows, _, bounds in textkit.slices(batch.column(1), BLOCK // 4):
            held.append(pa.RecordBatch.from_arrays(
                [batch.column(0).slice(at, rows), batch.column(1).slice(at, rows).cast(pa.large_string())],
                names=["id", "text"]))
            size += int(bounds[-1])
            if size >= BLOCK:
                yield flush()
                held, size = [], 0
    if held:
        yield flush()


class Block:
    """The texts of a block as one byte string."""

    def __init__(self, name: str):
        files, path = _files(name)
        with files.open_input_file(path) as source:
            table = pa.ipc.open_file(source).read_all()
        self.ids = table.column(0).combine_chunks()
        texts = table.column(1).combine_chunks()
        parts = list(textkit.slices(texts, 1 << 62))
        self.buf, self.bounds = (parts[0][2], parts[0][3]) if parts else (np.zeros(0, np.uint8), np.zeros(1, np.int64))
        self.ends = self.bounds[1:]

    def names(self, at: np.ndarray, size: int) -> np.ndarray:
        """Names of the strings of ``size`` bytes at the given ascending offsets."""
        out, i = np.empty(len(at), np.uint64), 0
        while i < len(at):
            to = int(np.searchsorted(at, at[i] + textkit.SLICE_BYTES, "right"))
            low = int(at[i])
            sums = textkit.prefix_hash(self.buf[low:int(at[to - 1]) + size])
            out[i:to] = textkit.span_hash(sums, at[i:to] - low, at[i:to] - low + size)
            i = to
        return out

    def sampled(self, size: int) -> np.ndarray:
        """Sampled offsets with ``size`` bytes before the end of their text."""
        out = []
        for low, high in zip(self.bounds[:-1].tolist(), self.ends.tolist()):
            if high - low >= size:
                n = high - low - size + 1
                at = (np.arange(0, n, V)[:, None] + COVER).ravel()
                out.append(low + at[at < n])
        return np.concatenate(out) if out else np.zeros(0, np.int64)

    def reached(self, tuples: np.ndarray, length: int) -> np.ndarray:
        """Offsets with ``length`` bytes left and one of the tuples at less than V bytes after them."""
        change = np.zeros(len(self.buf) + 1, np.int32)
        row = np.searchsorted(self.ends, tuples, "right")
        low = np.maximum(tuples - V + 1, self.bounds[row])
        high = np.minimum(tuples, self.ends[row] - length) + 1
        ok = high > low
        np.add.at(change, low[ok], 1)
        np.add.at(change, high[ok], -1)
        return np.flatnonzero(np.cumsum(change[:-1]) > 0)


# --- naming ------------------------------------------------------------------------

def _deal(block: str, names: np.ndarray, buckets: int, width: int):
    """Rows ``bucket, block, names, often`` of the distinct names; ``often``: a bit for each held twice."""
    distinct, counts = np.unique(names, return_counts=True)
    bucket = (distinct >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
    edges = np.searchsorted(bucket, np.arange(buckets + 1))
    for b in range(buckets):
        low, high = edges[b], edges[b + 1]
        if high > low:
            part = distinct[low:high]
            # names of a bucket share their high bits; the tuples' names are only a filter and lose some bits
            data = part.astype("<u4") if width == 4 else part.astype("<u8")
            yield b, block, data.tobytes(), np.packbits(counts[low:high] > 1).tobytes()


def _rows(dealt, bucket_names):
    """Record batches of dealt rows."""
    for b, block, names, often in dealt:
        yield pa.RecordBatch.from_arrays(
            [pa.array([b], pa.int32()), pa.array([block]), pa.array([names], pa.binary()),
             pa.array([often], pa.binary())], names=bucket_names)


_DEALT = ["bucket", "block", "names", "often"]
_DEALT_TYPE = "bucket int, block string, names binary, often binary"


def _answers(width: int):
    """Bucket by bucket: sort the names of all blocks, compare neighbours, answer one bit per name."""
    def answer(table: pa.Table) -> pa.Table:
        kind = "<u4" if width == 4 else "<u8"
        names = [np.frombuffer(x, kind) for x in table["names"].to_pylist()]
        sizes = np.array([len(x) for x in names])
        often = np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8), count=n).astype(bool)
                                for x, n in zip(table["often"].to_pylist(), sizes)])
        every = np.concatenate(names)
        order = np.argsort(every, kind="stable")
        ranked = every[order]
        same = ranked[1:] == ranked[:-1]
        equal = np.zeros(len(every), bool)
        equal[order[1:]] |= same
        equal[order[:-1]] |= same
        equal |= often
        edges = np.concatenate([[0], np.cumsum(sizes)])
        bits = [np.packbits(equal[low:high]).tobytes() for low, high in zip(edges[:-1], edges[1:])]
        return pa.table({"block": table["block"], "bucket": table["bucket"],
                         "bits": pa.array(bits, pa.binary())})

    return answer


def _named(dealt: DataFrame, width: int) -> DataFrame:
    return dealt.groupBy("bucket").applyInArrow(_answers(width), "block string, bucket int, bits binary")


def _with_blocks(blocks: DataFrame, answers: DataFrame) -> DataFrame:
    """Answers together with one empty row for each block, so that blocks without names stay."""
    return answers.unionByName(blocks.select("block", F.lit(-1).alias("bucket"), F.lit(b"").alias("bits")))


def _equal(names: np.ndarray, table: pa.Table, buckets: int) -> np.ndarray:
    """Which of the names have an equal elsewhere, by the answers that came back."""
    distinct, inverse = np.unique(names, return_inverse=True)
    bucket = (distinct >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
    edges = np.searchsorted(bucket, np.arange(buckets + 1))
    equal = np.zeros(len(distinct), bool)
    for b, bits in zip(table["bucket"].to_pylist(), table["bits"].to_pylist()):
        if b >= 0:
            low, high = edges[b], edges[b + 1]
            equal[low:high] = np.unpackbits(np.frombuffer(bits, np.uint8), count=high - low).astype(bool)
    return equal[inverse] if len(names) else np.zeros(0, bool)


def repeated_bytes(docs: DataFrame, length: int = 200, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document row: ``id, n_bytes, spans, kept``.

    ``spans`` are the maximal runs of removed bytes (end exclusive), ``kept`` the remaining bytes.
    A null text is empty; a text of fewer than ``length`` bytes keeps all; rows of one id are
    documents of their own; equal rows repeat each other.  Names are 64 bits: among n suffixes
    two different strings share one with a probability of about n * n / 2**65.
    """
    if length < 2 * V:
        raise ValueError(f"length must be at least {2 * V}")
    spark, size = docs.sparkSession, length - V + 1
    folder = scratch_dir(spark, "suffixes")
    given = small_batches(docs).select(F.col(doc_id).alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    kind = given.schema["id"].dataType.simpleString()
    blocks = written(given.mapInArrow(lambda batches: _store(batches, folder), "block string, n_bytes long"),
                     "blocks")
    total, count = blocks.agg(F.sum("n_bytes"), F.count("*")).first()
    buckets = max(1, -(-(total or 0) // BUCKET_BYTES))
    finer = 8 * buckets  # up to all suffixes, of 8 bytes each
    spread = blocks.select("block").repartition(max(1, count), "block")

    def tuples(batches):
        for batch in batches:
            for name in batch.column(0).to_pylist():
                block = Block(name)
                yield from _rows(_deal(name, block.names(block.sampled(size), size), buckets, 4), _DEALT)

    first = written(_with_blocks(blocks, _named(spread.mapInArrow(tuples, _DEALT_TYPE), 4)), "tuples")

    def survivors(block: Block, table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        sampled = block.sampled(size)
        at = block.reached(sampled[_equal(block.names(sampled, size), table, buckets)], length)
        return at, block.names(at, length)

    def prefixes(table: pa.Table) -> pa.Table:
        name = table["block"][0].as_py()
        _, names = survivors(Block(name), table)
        made = list(_rows(_deal(name, names, finer, 8), _DEALT))
        return pa.Table.from_batches(made) if made else pa.table(
            {"bucket": pa.array([], pa.int32()), "block": pa.array([], pa.string()),
             "names": pa.array([], pa.binary()), "often": pa.array([], pa.binary())})

    second = _named(first.groupBy("block").applyInArrow(prefixes, _DEALT_TYPE), 8)
    both = first.withColumn("step", F.lit(1)).unionByName(second.withColumn("step", F.lit(2)))

    def cut(table: pa.Table) -> pa.Table:
        block = Block(table["block"][0].as_py())
        step = table["step"].to_numpy()
        at, names = survivors(block, table.filter(pa.array(step == 1)))
        at = at[_equal(names, table.filter(pa.array(step == 2)), finer)]
        change = np.zeros(len(block.buf) + 1, np.int32)
        change[at] += 1
        change[at + length] -= 1  # offsets are distinct, and strings end inside their text
        gone = np.cumsum(change[:-1]) > 0
        sizes, spans, kept = [], [], []
        for low, high in zip(block.bounds[:-1].tolist(), block.ends.tolist()):
            part = gone[low:high]
            edge = np.flatnonzero(np.diff(np.concatenate([[0], part.view(np.int8), [0]])))
            sizes.append(high - low)
            spans.append([{"start": s, "end": e} for s, e in zip(edge[::2].tolist(), edge[1::2].tolist())])
            kept.append(block.buf[low:high][~part].tobytes())
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return pa.table({"id": block.ids, "n_bytes": pa.array(sizes, pa.int64()), "spans": pa.array(spans, span),
                         "kept": pa.array(kept, pa.binary())})

    return both.groupBy("block").applyInArrow(
        cut, f"id {kind}, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")


def removed_counts(docs: DataFrame, **options) -> DataFrame:
    """The digest columns of ``repeated_bytes``."""
    return repeated_bytes(docs, **options).select(
        "id", "n_bytes",
        F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + s["end"] - s["start"]).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
