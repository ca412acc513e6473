"""Sets of word shingles: inside tasks, as a table, and the exact check of pairs."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import textkit
from tidemark.llm.scratch import Scratch

MAP_WORDS = 16   # 64 bit words of a small set's bitmap; a larger set has twice as many, and so on
COARSE = 8       # and of the folded one


def slice_sets(buf: np.ndarray, bounds: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``(row, hash)`` of the distinct shingles of a slice, sorted by row."""
    buf = textkit.LOWER[buf]
    starts, ends, first = textkit.words(buf, bounds, textkit.SPACED)
    hashes, sizes = textkit.word_hashes(buf, starts, ends), np.diff(first)
    g = textkit.grams(hashes, n)
    row, ok = textkit.gram_rows(first, n, len(g))
    rows, values = [row[ok]], [g[ok]]
    for fewer in range(1, n):  # the whole sequence is the only shingle
        short = np.flatnonzero(sizes == fewer)
        if len(short):
            rows.append(short)
            values.append(textkit.grams(hashes, fewer)[first[:-1][short]])
    row, value = np.concatenate(rows), np.concatenate(values)
    order = np.lexsort((value, row)) if len(bounds) > 2 else np.argsort(value)
    row, value = row[order], value[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    return row[new], value[new]


def bitmap(value: np.ndarray) -> np.ndarray:
    """Parity of the number of shingles at each place; a place for each shingle at least, else all would be even odds."""
    bits = 64 * MAP_WORDS
    while bits < len(value):
        bits *= 2
    place = (textkit.mix(value ^ textkit.ODD) % np.uint64(bits)).astype(np.int64)
    odd = np.bincount(place, minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view("<i8")


def _added(words: Column) -> Column:
    return F.aggregate(words, F.lit(0).cast("long"), lambda total, w: total.bitwiseXOR(w))


FOLDS = tuple(f"fold{i}" for i in range(COARSE))


def folds() -> list[Column]:
    """The bitmap folded to few words, as plain columns for joins that compare very many pairs.

    Words that fall together are added modulo 2.
    """
    def every(i: int) -> Column:
        return F.filter(F.col("bitmap"), lambda _, at: at % COARSE == i)

    return [_added(every(i)).alias(c) for i, c in enumerate(FOLDS)]


def folds_alike(percent: int) -> Column:
    """Filters on sizes and the plain columns of ``x`` and ``y`` that no linked pair fails, compiled to machine code."""
    small, large = F.least("x.size", "y.size"), F.greatest("x.size", "y.size")
    differ = sum((F.bit_count(F.col(f"x.{c}").bitwiseXOR(F.col(f"y.{c}"))) for c in FOLDS), F.lit(0))
    return (100 * small >= percent * large) & (
        differ * (100 + percent) <= (100 - percent) * (F.col("x.size") + F.col("y.size")))


def _differing(x: Column, y: Column) -> Column:
    return F.aggregate(F.zip_with(x, y, lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda n, k: n + k)


def _halved(words: Column) -> Column:
    half = (F.size(words) / 2).cast("int")
    return F.transform(F.slice(words, F.lit(1), half), lambda w, at: w.bitwiseXOR(words[at + half]))


def maps_alike(percent: int) -> Column:
    """A filter on the whole bitmaps of ``x`` and ``y`` that no linked pair fails; the longer one is folded."""
    x, y = F.col("x.bitmap"), F.col("y.bitmap")
    differ = F.when(F.size(x) == F.size(y), _differing(x, y)).when(
        F.size(x) == 2 * F.size(y), _differing(_halved(x), y)).when(
        2 * F.size(x) == F.size(y), _differing(x, _halved(y))).otherwise(F.lit(0))
    return differ * (100 + percent) <= (100 - percent) * (F.col("x.size") + F.col("y.size"))


def whole_sets(given: DataFrame, n: int) -> DataFrame:
    """Per row of ``id, text`` its ``id, shingles``."""
    kind = given.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for at, rows, buf, bounds in textkit.slices(batch.column(1)):
                row, value = slice_sets(buf, bounds, n)
                edges = np.searchsorted(row, np.arange(rows + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, rows),
                     pa.ListArray.from_arrays(pa.array(edges), pa.array(value.view(np.int64)))],
                    names=["id", "shingles"])

    return given.mapInArrow(run, f"id {kind}, shingles array<long>")


def verified(pairs: DataFrame, given: DataFrame, n: int, percent: int, name: str, held: Scratch) -> DataFrame:
    """The pairs ``a, b`` whose whole sets are linked, as a table of that name."""
    pairs = held.written(pairs, "candidates")
    needed = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()
    sets = held.written(whole_sets(given.join(needed, "id", "left_semi"), n), "sets")
    both = pairs.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("x")), "a") \
        .join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("y")), "b")
    common = F.size(F.array_intersect("x", "y"))
    links = held.written(both.filter(100 * common >= percent * (F.size("x") + F.size("y") - common)).select("a", "b"),
                         name)
    held.drop("candidates", "sets")
    return links
