"""Pairs of one key that are not in one component yet."""

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import ngramjoin, minhash, shingles
from tidemark.llm.components import drawn_pairs, pairs_across, still_apart


def test_pairs_across_are_all_pairs_of_two_components(spark):
    rows = [(k, i, 0 if i < 40 else i) for k in (1, 2) for i in range(40 + 3 * k)]
    df = spark.createDataFrame(rows, "key long, id long, label long")
    got = sorted(tuple(r) for r in pairs_across(df, F.lit(True)).collect())
    assert got == sorted({(a, b) for k, a, la in rows for j, b, lb in rows if j == k and la != lb and a < b})
    drawn = drawn_pairs(df).collect()
    assert {tuple(r) for r in drawn} <= set(got) and drawn
    known = df.select("id", "label").distinct()
    assert still_apart(df.union(spark.createDataFrame([(3, 0, 0), (3, 1, 0)], df.schema)), known).select(
        "key").distinct().count() == 2


def test_open_pairs_compare_short_marks():
    # whole bitmaps and signatures in the condition of that join made a method too long to be compiled
    for module in (ngramjoin, minhash):
        assert module.pairs_across is pairs_across and module.folds_alike


def test_keys_of_the_same_ids_are_one(spark):
    """Near copies share very many keys, and a pair was made once for each of them."""
    rows = [(k, i) for k in range(50) for i in (range(5) if k % 2 else range(2, 9))]
    shared = spark.createDataFrame([*rows, *rows[:5]], "key long, id long")  # one key has its ids twice
    known = spark.createDataFrame([(i, i) for i in range(9)], "id long, label long")
    left = [tuple(r) for r in still_apart(shared, known).collect()]
    assert len({k for k, _ in left}) == 3
    assert {i for _, i in left} == set(range(9))


def test_drawn_pairs_pass_the_filter_before_they_leave_their_key(spark):
    rows = spark.createDataFrame([(k, i, i, 100 + 10 * i) for k in range(3) for i in range(30)],
                                 "key long, id long, label long, size long")
    near = F.abs(F.col("x.size") - F.col("y.size")) <= 10
    pairs = drawn_pairs(rows, near).collect()
    assert pairs and all(r.b - r.a == 1 for r in pairs)


def test_maps_of_large_sets_tell_them_apart(spark):
    """Sets of thousands that share 6 of 10 filled a bitmap of fixed size; linked ones always pass, whatever their sizes."""
    rng = np.random.default_rng(3)

    def row(i, value):
        return i, len(value), [int(w) for w in shingles.bitmap(value)]

    def passed(x, y, percent):
        both = [spark.createDataFrame([row(i, v)], "id long, size long, bitmap array<long>").select(
            "id", "size", "bitmap", *shingles.folds()).alias(n) for i, n, v in ((0, "x", x), (1, "y", y))]
        pair = both[0].crossJoin(both[1])
        return bool(pair.filter(shingles.folds_alike(percent) & shingles.maps_alike(percent)).count())

    def some(n):
        return rng.integers(0, 1 << 63, n, dtype=np.uint64)

    common = some(6000)
    assert not passed(np.concatenate([common, some(2000)]), np.concatenate([common, some(2000)]), 80)
    for size in (20, 1000):
        base = some(size)
        assert passed(base, np.concatenate([base, some(size // 4)]), 80)  # also across two lengths of maps
        assert passed(np.concatenate([base, some(size // 4)]), base, 80)
    assert passed(common, common[:2000], 30)
