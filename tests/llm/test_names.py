"""Columns that have the names of internal ones, rows without id and repeated rows."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from tidemark.llm import decontaminate, langid, lines, mixing, ngramjoin, quality
from tidemark.llm.queries import vocabulary

from .conftest import odd_rows, prose, table_of


def clashing(df, *names):
    return df.withColumns({c: F.lit(f"own {c}") for c in names})


def same(df, names):
    row = df.select(*names).distinct().collect()
    assert len(row) == 1 and list(row[0]) == [f"own {c}" for c in names]


def test_lines(spark, odd):
    names = ["_doc", "_VERSION", "gone", "doc", "key", "place"]
    got = lines.drop_repeated_lines(clashing(odd, *names))
    same(got, names)
    plain = lines.drop_repeated_lines(odd)
    assert sorted(table_of(got.select(*plain.columns)), key=str) == sorted(table_of(plain), key=str)


def test_mix(spark, odd):
    names = ["_row", "_of", "_hash", "_place", "places", "copies", "size", "source_size"]
    got = mixing.shuffled(mixing.mixed(clashing(odd, *names, "_shard", "_rank")))
    same(got, [c for c in names if c in got.columns])
    assert got.count() == mixing.mixed(odd).count()


def test_quality(spark, odd):
    names = ["_lang", "_class", "_band", "_lang_of", "_lang_band", "_cell_band", "_whole_band", "_level"]
    path = vocabulary("piece_bpe_32k.model")
    got = quality.quality(clashing(odd, *names), path)
    same(got, names)
    plain = quality.quality(odd, path)
    assert sorted(table_of(got.select("doc_id", "kept")), key=str) == sorted(table_of(plain.select("doc_id", "kept")), key=str)


def test_language(spark, sf_docs):
    model = langid.fit(sf_docs)
    got = langid.predict(clashing(sf_docs, "_letter", "score"), model)
    same(got, ["_letter"])
    plain = langid.predict(sf_docs, model).select("doc_id", "lang_pred")
    assert sorted(table_of(got.select("doc_id", "lang_pred"))) == sorted(table_of(plain))


def test_decisions_by_id_and_text(spark):
    rng = random.Random(2)
    item, clean, other = prose(rng, 30), prose(rng, 40, 9000), prose(rng, 40, 9000)
    rows = [(None, f"{clean} {item}"), (None, clean), (None, other), (1, item), (1, other), (2, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([("x", item)], "item_id string, text string")
    got = decontaminate.drop_contaminated(clashing(df, "_key", "digest", "items"), items)
    same(got, ["_key", "digest", "items"])
    assert sorted(table_of(got.select("doc_id", "text")), key=str) == sorted(
        [(None, clean), (None, other), (1, other), (2, None)], key=str)


def test_one_of_equal_rows(spark):
    rng = random.Random(4)
    text, other = prose(rng, 60), prose(rng, 60, 9000)
    rows = [(1, text), (1, text), (None, text), (None, text), (None, other), (None, other), (7, f"{text} more"), (8, None),
            (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = ngramjoin.one_per_component(clashing(df, "_key", "_version", "component_id"))
    same(got, ["_key", "_version", "component_id"])
    assert sorted(table_of(got.select("doc_id", "text")), key=str) == sorted(
        [(1, text), (None, other), (8, None), (None, None)], key=str)
    names = df.withColumn("doc_id", F.col("doc_id").cast("string"))
    assert sorted(table_of(ngramjoin.one_per_component(names)), key=str) == sorted(
        [("1", text), (None, other), ("8", None), (None, None)], key=str)
