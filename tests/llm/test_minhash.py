from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import minhash, scratch

from .conftest import odd_rows, prose, table_of
from .test_ngramjoin import brute, corpus, edited


def check(spark, docs, n=3, percent=85):
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = table_of(minhash.near_duplicates(df, n=n, percent=percent))
    assert sorted(got) == sorted(brute(docs, percent, n))


@pytest.mark.parametrize("seed, n, percent", [(0, 3, 85), (1, 3, 85), (2, 5, 80)])
def test_against_brute_force(spark, seed, n, percent):
    check(spark, corpus(random.Random(seed)), n, percent)


def test_large_group_of_near_copies(spark):
    """Hundreds of near copies, and texts that share most keys without being linked."""
    rng = random.Random(7)
    base = prose(rng, 120, 5000)
    docs = [edited(rng, base, rng.randrange(4)) for _ in range(300)]
    docs += [edited(rng, base, rng.randrange(12, 30)) for _ in range(60)]
    check(spark, list(enumerate(docs)))


def test_odd_table(spark, odd, nothing):
    rows = [(r[0], r[1]) for r in odd_rows()]
    clash = odd.withColumn("id", F.lit("x")).withColumn("signature", F.lit(1)).withColumn("label", F.lit(2))
    for df in (odd, clash):
        got = table_of(minhash.near_duplicates(df, n=3, percent=85))
        assert len(got) == len(rows)
        with_id = [r for r in rows if r[0] is not None]
        assert sorted(r for r in got if r[0] is not None) == sorted(brute(with_id, 85))
        assert sorted((r[1:] for r in got if r[0] is None), key=str) == [(0, None), (1, None)]
    assert minhash.near_duplicates(nothing).count() == 0


def test_every_pair_within_the_distance_shares_a_key():
    """The pigeonhole guarantee, on signatures with exactly the allowed number of differing values."""
    rng = np.random.default_rng(3)
    for percent in (80, 85, 90):
        values, distance = minhash.plan(percent)
        kept = minhash.patterns(values, distance)
        for _ in range(300):
            differ = np.zeros(values, bool)
            differ[rng.choice(values, distance, replace=False)] = True
            assert any(not differ[list(places)].any() for places in kept)
    # also where chunks may hold several errors
    values = 16
    for distance in range(1, 11):
        kept = minhash.patterns(values, distance)
        for _ in range(100):
            differ = np.zeros(values, bool)
            differ[rng.choice(values, distance, replace=False)] = True
            assert any(not differ[list(places)].any() for places in kept)


def test_signatures_differ_as_the_sets_do():
    """Values differ about as often as the Jaccard says, and hardly any linked pair is beyond the distance."""
    rng = np.random.default_rng(5)
    values, distance = minhash.plan(85)
    assert minhash.beyond(values, distance, 0.15) < minhash.MISS
    share, most = [], 0
    for _ in range(200):
        common, left, right = (rng.integers(0, 1 << 63, k, dtype=np.uint64) for k in (170, 15, 15))
        a, b = (minhash.minima(np.sort(np.concatenate([common, x])), np.array([0, 185]), values)[0] for x in (left, right))
        share.append((a != b).mean())
        most = max(most, int((a != b).sum()))
    assert abs(np.mean(share) - 0.15) < 0.02 and most <= distance


def test_intermediate_tables_go(spark, tmp_path):
    held = scratch.Scratch(spark)
    df = held.written(spark.range(5), "x")
    assert df.count() == 5 and scratch.CLEANUP
    path = held.paths["x"][0]
    held.drop("x", "never made")
    assert not held.paths
    with pytest.raises(Exception):
        spark.read.parquet(path)
