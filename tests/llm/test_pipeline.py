from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

pytest.importorskip("public_tokenizers")
corpus_pipeline = pytest.importorskip("corpus_pipeline")

from tidemark.llm import mixing, quality  # noqa: E402

from . import test_decontaminate, test_mixing, test_ngramjoin, test_tokenfiles  # noqa: E402, F401
from .conftest import SCHEMA, SF_DIR, prose, table_of  # noqa: E402

STAGE = dict(corpus_pipeline.STAGES)


def ids(df):
    return sorted(r[0] for r in df.select("doc_id").collect())


def test_every_stage_against_brute_force(spark, tmp_path):
    """Each stage on what the one before kept, as the runner does it."""
    df = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    steps = []
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, df, SF_DIR)
        if n < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == df.columns and [f.dataType for f in out.schema] == [f.dataType for f in df.schema]
        out.write.parquet(f"{tmp_path}/{n}")
        steps.append((df, spark.read.parquet(f"{tmp_path}/{n}")))
        df = steps[-1][1]

    before, after = steps[0]
    judged = quality.quality(before, corpus_pipeline.vocabulary("piece_bpe_32k.model"))
    assert ids(after) == ids(judged.filter("kept")) and 0 < after.count() < before.count()
    assert judged.filter("base_failed AND kept").count() == 0

    before, after = steps[1]
    docs = table_of(before.select("doc_id", "text"))
    assert ids(after) == sorted(d for d, _, c in test_ngramjoin.brute(docs, 80, 5) if c == d)

    before, after = steps[2]
    docs = table_of(before.select("doc_id", "text"))
    hit = test_decontaminate.brute(docs, table_of(items.select("item_id", "text")))
    assert ids(after) == sorted(d for d, *_, bad in hit if not bad)

    before, after = steps[3]
    copies = {r["doc_id"]: r["copies"] for r in mixing.planned(before).collect()}
    assert {r["doc_id"]: r["count"] for r in after.groupBy("doc_id").count().collect()} == {
        k: n for k, n in copies.items() if n}
    assert after.distinct().count() == sum(n > 0 for n in copies.values())  # whole, unchanged rows

    before, after = steps[4]
    docs = sorted(table_of(before.select("doc_id", "text")))
    assert sorted(table_of(after), key=lambda r: r[1]) == test_tokenfiles.expected(docs)


def test_run_applies_all_stages(spark):
    got = corpus_pipeline.run(spark, SF_DIR)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and got.count() > 0
    assert got.agg(F.max(F.col("start") + F.col("n_tokens")) - F.sum("n_tokens")).first()[0] == 0


def test_stages_take_odd_and_empty_tables(spark, odd, nothing):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, SF_DIR).count() == 0, name
        assert stage(spark, odd, SF_DIR).count() <= 4 * odd.count(), name
    assert ids(STAGE["n-gram Jaccard join"](spark, odd.filter("doc_id IS NOT NULL"), SF_DIR)) == [1, 2, 3, 4, 6, 8, 10, 11]


def test_near_duplicates_by_five_words_and_four_fifths(spark):
    """Scattered edits and added passages, on either side of the limit."""
    rng = random.Random(21)
    docs = []
    for _ in range(12):
        words = prose(rng, 400, 5000).split()
        docs.append(" ".join(words))
        for edits in (4, 7, 8, 9, 10, 14):
            copy = list(words)
            for i in rng.sample(range(400), edits):
                copy[i] = f"n{rng.randrange(9999)}"
            docs.append(" ".join(copy))
        docs += [" ".join(words + prose(rng, extra, 5000).split()) for extra in (30, 60, 80, 120)]
    rng.shuffle(docs)
    df = spark.createDataFrame([(i, t, "en", "a", 0) for i, t in enumerate(docs)], SCHEMA)

    def smallest(n, percent):
        sets = [test_ngramjoin.shingles(t, n) for t in docs]
        root = list(range(len(docs)))
        for i in range(len(docs)):
            for j in range(i):
                both = len(sets[i] & sets[j])
                if 100 * both >= percent * len(sets[i] | sets[j]):
                    a, b = sorted((root[i], root[j]))
                    root = [a if r == b else r for r in root]
        return sorted(set(root))

    assert ids(STAGE["n-gram Jaccard join"](spark, df, SF_DIR)) == smallest(5, 80) != smallest(3, 90)
