from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.llm import langid


def test_held_out_accuracy(spark, sf_docs):
    docs = sf_docs.withColumn("held", F.crc32(F.col("doc_id").cast("string")) % 5 == 0)
    got = langid.predict(docs, langid.fit(docs.filter("NOT held")))
    share = got.filter("held AND lang IS NOT NULL").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert share > 0.95
    assert got.filter("score < 0 OR score > 1").count() == 0


def test_odd_rows(spark, odd, nothing, sf_docs):
    model = langid.fit(sf_docs)
    clash = odd.withColumn("score", F.lit("x"))
    got = langid.predict(clash, model)
    assert got.count() == odd.count() and got.columns[-3:] == ["lang_pred", "score", "rejected"]
    none = got.filter(F.coalesce(F.col("text"), F.lit("")).rlike(r"\p{L}") == F.lit(False))
    assert {r[0] for r in none.select("lang_pred").collect()} == {"und"} and none.count() == 4
    assert got.filter("text IS NOT NULL AND lang_pred <> 'und'").count() == odd.count() - 4
    assert langid.predict(nothing, model).count() == 0
    empty = langid.fit(nothing)
    assert {r[0] for r in langid.predict(odd, empty).select("lang_pred").collect()} == {"und"}


def test_far_texts_are_rejected(spark, sf_docs):
    model = langid.fit(sf_docs)
    far = spark.createDataFrame([(1, "жёлтый фрукт и чёрная кошка, мягкая трава " * 20)], "doc_id long, text string")
    assert langid.predict(far, model).first()["rejected"]


def test_predictions_do_not_see_other_columns(spark, sf_docs):
    model = langid.fit(sf_docs)
    plain = langid.predict(sf_docs.select("doc_id", "text"), model).select("doc_id", "lang_pred", "score")
    other = langid.predict(sf_docs.withColumn("lang", F.lit("fr")), model).select("doc_id", "lang_pred", "score")
    assert plain.exceptAll(other).count() == 0
