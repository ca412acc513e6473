from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import mixing

from .conftest import SCHEMA, prose, table_of


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(4)
    rows = []
    for i in range(1500):
        source = "hot" if i % 3 == 0 else f"s{i % 7}"
        rows.append((i, prose(rng, int(rng.paretovariate(1.1) * 30) % 4000), "en", source, 0))
    return spark.createDataFrame(rows, SCHEMA)


def test_targets_share_and_stop():
    sizes, weights = {"a": 100, "b": 10, "c": 1000}, {"a": 5, "b": 5, "c": 1}
    got = mixing.targets(sizes, weights, 1110, 3)
    assert got["b"] == 30 and got["a"] == 300 and got["c"] == pytest.approx(780)
    assert mixing.targets({"a": 0}, {"a": 1}, 0, 3) == {"a": 0.0}


def test_splitting_tree_keeps_quotas_and_shards():
    quotas = np.array([0, 1, 17, 4000, 256])
    for shards in (1, 2, 5, 16):
        tree = mixing.splitting_tree(quotas, shards, np.random.default_rng(1))
        assert (tree.sum(axis=1) == quotas).all() and (tree >= 0).all()
        assert np.ptp(tree.sum(axis=0)) <= 4  # shards of equal size, but for rounding at the nodes


def test_taken_words_meet_the_targets(corpus):
    plan = mixing.planned(corpus)
    rows = plan.groupBy("source").agg(F.sum("size").alias("n"), F.max("source_size").alias("size"),
                                      F.max("target").alias("target"), F.sum(F.col("size") * F.col("copies")).alias("taken")
                                      ).collect()
    order = sorted(r["source"] for r in rows)
    sizes = {r["source"]: r["n"] for r in rows}
    want = mixing.targets(sizes, {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}, sum(sizes.values()), 3)
    for r in rows:
        assert r["size"] == r["n"] and r["target"] == pytest.approx(want[r["source"]])
        assert abs(r["taken"] - r["target"]) <= 0.005 * r["target"] + 30
    assert plan.filter("copies > 3").count() == 0


def test_reruns_and_partitions_agree(corpus):
    columns = ["doc_id", "size", "copies", "places"]
    first = sorted(map(repr, table_of(mixing.planned(corpus).select(columns))))
    assert first == sorted(map(repr, table_of(mixing.planned(corpus.repartition(7, "text")).select(columns))))


def test_mix_holds_every_copy_and_shards_are_even(corpus):
    mix = mixing.mixed(corpus, shards=8)
    want = {r["doc_id"]: r["copies"] for r in mixing.planned(corpus, shards=8).collect()}
    got = {r["doc_id"]: r["count"] for r in mix.groupBy("doc_id").count().collect()}
    assert got == {k: v for k, v in want.items() if v}
    sizes = [r["count"] for r in mix.groupBy("_shard").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 1.6 * min(sizes)
    assert mixing.shuffled(mix).count() == mix.count()


def test_odd_rows(odd, nothing):
    plan = mixing.planned(odd)
    assert plan.count() == odd.count() and mixing.planned(nothing).count() == 0
    assert plan.filter("doc_id = 1").first()["size"] == 0
    assert plan.filter("copies > 3").count() == 0
    twice = plan.filter("doc_id = 5").collect()
    assert len(twice) == 2 and twice[0] == twice[1]
    clash = odd.withColumnsRenamed({"n_chars": "target"}).withColumn("size", F.lit("x"))
    assert mixing.planned(clash).count() == odd.count()
    assert mixing.mixed(clash).columns == [*clash.columns, "_shard", "_rank"]


def test_gaps_of_long_documents_are_closed(spark):
    """Documents at the cut may hold a fifth of their source's words."""
    rng = random.Random(15)
    rows = []
    for s in range(12):
        long = [6000] * 4 if s % 3 else [60_000, 30_000, 15_000]
        sizes = long + [rng.randrange(20, 120) for _ in range(sum(long) // 170)]
        rows += [(1000 * s + i, prose(rng, n), "en", f"s{s:02}", 0) for i, n in enumerate(sizes)]
    docs = spark.createDataFrame(rows, SCHEMA)
    plan = mixing.planned(docs, weight_cycle=(3, 4, 5, 2, 6)).select(
        "doc_id", "source", "size", "target", "copies", "places").collect()
    for source in {r["source"] for r in plan}:
        of = [r for r in plan if r["source"] == source]
        gap = of[0]["target"] - sum(r["size"] * r["copies"] for r in of)
        least = min(r["copies"] for r in of)
        assert 0 <= gap < max(1, min((r["size"] for r in of if r["copies"] == least), default=1)), source
        assert max(r["copies"] for r in of) <= least + 1
    taken = {r["doc_id"]: r["copies"] for r in plan if r["copies"]}
    mix = mixing.mixed(docs, weight_cycle=(3, 4, 5, 2, 6))
    assert {r["doc_id"]: r["count"] for r in mix.groupBy("doc_id").count().collect()} == taken
