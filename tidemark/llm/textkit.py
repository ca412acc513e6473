"""Vectorised text helpers that run inside tasks.

Texts arrive as Arrow string columns.  They are taken as UTF-8 bytes, a bounded slice of rows at
a time, and words are found and hashed with numpy over the whole slice.  Hashes are 64 bit
polynomials over random byte values; two different words or word sequences share one with
probability of about 2**-60, and operators for which that matters compare the words as well.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are handled at once; a longer text is a slice of its own.
SLICE_BYTES = 1 << 20
ODD = np.uint64(0x9E3779B97F4A7C15)
BASE = np.uint64(0xD6E8FEB86659FD93)

_values = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class _Cache(dict):
    """Tables built once per process; travels empty."""

    def __reduce__(self):
        return _Cache, ()


_tables = _Cache()


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """Table of 256 flags, true in the inclusive ranges."""
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low:high + 1] = True
    return table


#: [^\x20\x09-\x0D]+ over UTF-8 bytes.
SPACED = ~byte_class((0x20, 0x20), (0x09, 0x0D))
#: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ over UTF-8 bytes, after lower-casing.
ALNUM = ~byte_class((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def slices(texts: pa.Array, size: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, rows, bytes, bounds)`` of consecutive rows; nulls are empty.

    ``bounds`` has one entry more than the slice has rows.
    """
    texts = pc.fill_null(texts, "")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if not len(texts):
        return
    _, offsets, data = texts.buffers()
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    offsets = np.frombuffer(offsets, kind)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
        yield at, to - at, data[offsets[at]:offsets[to]], offsets[at:to + 1] - offsets[at]
        at = to


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse modulo 2**64, at least ``n`` of them."""
    if "up" not in _tables or len(_tables["up"]) < n:
        size = max(n, SLICE_BYTES + 4096)
        inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
        for name, base in (("up", BASE), ("down", inverse)):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _tables[name] = np.multiply.accumulate(table)
    return _tables["up"], _tables["down"]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the entropy of 64 bit values over all bits."""
    h = (h ^ (h >> np.uint64(31))) * ODD
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def prefix_hash(buf: np.ndarray) -> np.ndarray:
    """Running polynomial sums, one entry more than bytes."""
    up, _ = _powers(len(buf) + 1)
    sums = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_values[buf] * up[:len(buf)], out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each span of the bytes that ``sums`` was made from."""
    _, down = _powers(len(sums))
    return mix((sums[ends] - sums[starts]) * down[starts])


def words(buf: np.ndarray, bounds: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(starts, ends, first)``: byte spans of all words, and the first word of each row.

    ``first`` has one entry more than there are rows.  Words never cross rows.
    """
    inside = np.zeros(len(buf) + 2, bool)
    inside[1:-1] = table[buf]
    starts = inside[1:-1] & ~inside[:-2]
    ends = inside[1:-1] & ~inside[2:]
    edges = bounds[1:-1]
    edges = edges[(edges > 0) & (edges < len(buf))]
    starts[edges] |= inside[1:-1][edges]
    ends[edges - 1] |= inside[1:-1][edges - 1]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each word; memory beyond the hashes is bounded by a slice or the longest word."""
    if len(buf) <= 2 * SLICE_BYTES:
        return span_hash(prefix_hash(buf), starts, ends)
    out, at = np.empty(len(starts), np.uint64), 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + SLICE_BYTES, "right")))
        low = starts[at]
        sums = prefix_hash(buf[low:ends[to - 1]])
        out[at:to] = span_hash(sums, starts[at:to] - low, ends[at:to] - low)
        at = to
    return out


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` consecutive words; empty if there are fewer."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    out = hashes[n - 1:n - 1 + count].copy()
    for j in range(n - 2, -1, -1):
        out *= BASE
        out += hashes[j:j + count]
    return mix(out + np.uint64(n))


def gram_rows(first: np.ndarray, n: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    """``(row, valid)`` of each n-gram over the words of a slice; valid ones lie in one row."""
    sizes = np.diff(first)
    row = np.repeat(np.arange(len(sizes)), sizes)[:max(count, 0)]
    at = np.arange(len(row)) + first[0]
    return row, at + n <= first[1:][row]


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))
