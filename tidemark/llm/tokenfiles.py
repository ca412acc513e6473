"""Token ids in Arrow files of fixed-size-list batches.

A file holds the ids of consecutive documents, cut into sequences of equal length: column ``tokens``
is a fixed-size list of unsigned 16 bit numbers (32 bit if the vocabulary is larger), column
``mask`` a fixed-size list of booleans, false in the padding after the last document.  The values of
a batch are one flat buffer, so a memory-mapped file gives any sequence, or any run of ids, without
copying or decoding.  A second file, ``.index.arrow``, has each document's id, first position and
length.

Documents are range-partitioned and sorted by id; each task writes one pair of files under a
temporary name in the shared folder and renames it, so a repeated task replaces its own files.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import textkit
from tidemark.llm.scratch import small_batches, written
from tidemark.llm.vocab import BpeEncoder, per_process
from tidemark.session import scratch_dir

END_ID = 1
SEQUENCE = 2048
BATCH_SEQUENCES = 256


def _schema(size: int, dtype) -> pa.Schema:
    return pa.schema([("tokens", pa.list_(pa.field("item", pa.from_numpy_dtype(dtype)), size)),
                      ("mask", pa.list_(pa.field("item", pa.bool_()), size))])


class Writer:
    """Appends runs of ids; holds one batch at most."""

    def __init__(self, folder: str, name: str, id_type: pa.DataType, length: int, dtype):
        from pyarrow import fs

        self.files, path = fs.FileSystem.from_uri(folder)
        self.files.create_dir(path, recursive=True)
        self.paths = [f"{path}/{name}.arrow", f"{path}/{name}.index.arrow"]
        self.temporary = [f"{path}/_{uuid.uuid4().hex}-{i}" for i in range(2)]
        self.length, self.dtype, self.position = length, dtype, 0
        self.schema = _schema(length, dtype)
        self.index_schema = pa.schema([("id", id_type), ("start", pa.int64()), ("n_tokens", pa.int64())])
        self.sinks = [self.files.open_output_stream(p) for p in self.temporary]
        self.out = pa.ipc.new_file(self.sinks[0], self.schema)
        self.index = pa.ipc.new_file(self.sinks[1], self.index_schema)
        self.pending, self.held = [], 0

    def add(self, ids: pa.Array, tokens: np.ndarray, sizes: np.ndarray) -> None:
        starts = self.position + np.cumsum(sizes) - sizes
        self.index.write_batch(pa.RecordBatch.from_arrays([ids, pa.array(starts), pa.array(sizes)],
                                                          schema=self.index_schema))
        self.position += len(tokens)
        self.pending.append(tokens.astype(self.dtype))
        self.held += len(tokens)
        if self.held >= self.length * BATCH_SEQUENCES:
            whole = np.concatenate(self.pending)
            cut = len(whole) // self.length * self.length
            for i in range(0, cut, self.length * BATCH_SEQUENCES):
                self._batch(whole[i:min(cut, i + self.length * BATCH_SEQUENCES)])
            self.pending, self.held = [whole[cut:]], len(whole) - cut

    def _batch(self, tokens: np.ndarray) -> None:
        n = -(-len(tokens) // self.length) * self.length
        values = np.zeros(n, self.dtype)
        values[:len(tokens)] = tokens
        self.out.write_batch(pa.RecordBatch.from_arrays([
            pa.FixedSizeListArray.from_arrays(pa.array(values), self.length),
            pa.FixedSizeListArray.from_arrays(pa.array(np.arange(n) < len(tokens)), self.length),
        ], schema=self.schema))

    def close(self) -> None:
        if self.held:
            self._batch(np.concatenate(self.pending))
        for writer, sink in ((self.out, self.sinks[0]), (self.index, self.sinks[1])):
            writer.close()
            sink.close()
        for held, path in zip(self.temporary, self.paths):
            self.files.move(held, path)


class TokenFile:
    """Random access to one file and its index."""

    def __init__(self, uri: str):
        from pyarrow import fs

        files, path = fs.FileSystem.from_uri(uri)
        local = isinstance(files, fs.LocalFileSystem)

        def opened(p):
            return pa.ipc.open_file(pa.memory_map(p) if local else files.open_input_file(p))

        self.file, self._index = opened(path), opened(path.removesuffix(".arrow") + ".index.arrow")
        self.length = self.file.schema.field("tokens").type.list_size
        self.per_batch = [None] * self.file.num_record_batches
        self.first = [0]
        for i in range(self.file.num_record_batches):
            self.first.append(self.first[-1] + self._values(i).shape[0])

    def _values(self, i: int) -> np.ndarray:
        if self.per_batch[i] is None:
            self.per_batch[i] = self.file.get_batch(i).column(0).flatten().to_numpy(zero_copy_only=True)
        return self.per_batch[i]

    def sequence(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and mask of the i-th sequence."""
        at = int(np.searchsorted(self.first, i * self.length, "right")) - 1
        batch, row = self.file.get_batch(at), i - self.first[at] // self.length
        return (batch.column(0).flatten().to_numpy()[row * self.length:(row + 1) * self.length],
                batch.column(1).flatten().to_numpy(zero_copy_only=False)[row * self.length:(row + 1) * self.length])

    def run(self, start: int, size: int) -> np.ndarray:
        """``size`` ids from ``start``; a view unless it spans batches."""
        at = max(0, int(np.searchsorted(self.first, start, "right")) - 1)
        if not size or start + size <= self.first[at + 1]:
            return self._values(at)[start - self.first[at]:start - self.first[at] + size] if size else np.zeros(0, int)
        parts = []
        while size:
            values = self._values(at)[start - self.first[at]:][:size]
            parts.append(values)
            start, size, at = start + len(values), size - len(values), at + 1
        return np.concatenate(parts)

    def index(self):
        """Batches of ``id, start, n_tokens``."""
        for i in range(self._index.num_record_batches):
            yield self._index.get_batch(i)


def write_tokens(docs: DataFrame, tokenizer: str, folder: str | None = None, doc_id: str = "doc_id",
                 text: str = "text", end_id: int = END_ID, length: int = SEQUENCE) -> DataFrame:
    """Encode and write all texts; returns one row per file: ``part, path, n_docs, n_tokens``.

    Files follow the order of ids, null first; rows of one id follow a hash of their text.  A null
    or empty text is its end id alone.  ``folder`` must be reachable from all executors.
    """
    folder = folder or _uri(scratch_dir(docs.sparkSession, "tokens"))
    given = small_batches(docs).select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text"))
    order = [F.col("id"), F.xxhash64("text")]
    given = given.repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches):
        from pyspark import TaskContext

        part, writer, n_docs = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if writer is None:
                encoder = per_process(("bpe", tokenizer), lambda: BpeEncoder(tokenizer))
                writer = Writer(folder, f"part-{part:06d}", batch.column(0).type, length,
                                np.uint16 if encoder.size <= 1 << 16 else np.uint32)
            for at, rows, buf, bounds in textkit.slices(batch.column(1)):
                tokens, sizes = encoder.encode(buf, bounds)
                out = np.insert(tokens, np.cumsum(sizes), end_id)
                writer.add(batch.column(0).slice(at, rows), out, sizes + 1)
                n_docs += rows
        if writer is not None:
            writer.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([f"{folder}/part-{part:06d}.arrow"]),
                 pa.array([n_docs], pa.int64()), pa.array([writer.position], pa.int64())],
                names=["part", "path", "n_docs", "n_tokens"])

    return written(given.mapInArrow(run, "part int, path string, n_docs long, n_tokens long"), "manifest")


def _uri(path: str) -> str:
    return path if "://" in path or path.startswith("file:") else f"file://{path}"


def read_documents(files: DataFrame, id_type: str = "long") -> DataFrame:
    """Per document, from the files alone: ``id, start, n_tokens, ids_crc32``.

    ``start`` counts the ids of all documents before it; ``ids_crc32`` is over unsigned 32 bit little-endian
    numbers.  The list of files (a few numbers per file) is summed up on the driver.
    """
    spark = files.sparkSession
    listed = sorted(files.collect(), key=lambda r: r["part"])
    before, rows = 0, []
    for r in listed:
        rows.append((r["path"], before))
        before += r["n_tokens"]
    held = spark.createDataFrame(rows, "path string, before long").repartition(max(1, len(rows)))

    def run(batches):
        for batch in batches:
            for path, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                file = TokenFile(path)
                for part in file.index():
                    starts, sizes = part.column(1).to_pylist(), part.column(2).to_pylist()
                    crc = [zlib.crc32(file.run(s, n).astype("<u4").tobytes()) for s, n in zip(starts, sizes)]
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0), pa.array([s + first for s in starts], pa.int64()), part.column(2),
                         pa.array(crc, pa.int64())], names=["id", "start", "n_tokens", "ids_crc32"])

    return held.mapInArrow(run, f"id {id_type}, start long, n_tokens long, ids_crc32 long")
