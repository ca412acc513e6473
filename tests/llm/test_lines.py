from __future__ import annotations

import random

from pyspark.sql import functions as F

from tidemark.llm import lines

from .conftest import table_of

LOWER = {i: i + 32 for i in range(65, 91)}


def brute(docs, least_chars=40, least_docs=5):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    order = lambda d: (d is not None, d or 0)
    held = {}
    for d, text in docs:
        for line in (text or "").split("\n"):
            if len(key(line)) >= least_chars:
                held.setdefault(key(line), set()).add(d)
    out = []
    for d, text in docs:
        whole = (text or "").split("\n")
        kept = [x for x in whole if len(held.get(key(x), ())) < least_docs or max(held[key(x)], key=order) == d]
        out.append((d, "\n".join(kept), len(whole), len(whole) - len(kept)))
    return out


def check(df, **options):
    docs = table_of(df.select("doc_id", "text"))
    got = lines.drop_repeated_lines(df.select("doc_id", "text"), **options)
    assert sorted(map(repr, table_of(got))) == sorted(map(repr, brute(docs, **options)))


def test_against_brute_force(spark):
    rng = random.Random(5)
    pool = [("Line %d " % i) + "x" * rng.randrange(25, 60) for i in range(40)] + ["é" * 40, "É" * 39, "ÄB" * 20]
    docs = []
    for i in range(80):
        text = "\n".join(rng.choice(["", " ", "\t", "\r"]) + rng.choice([str.upper, str.lower, str])(rng.choice(pool))
                         + rng.choice(["", " ", "\x0b\x0c", "\r"]) for _ in range(rng.randrange(12)))
        docs.append((i, text + rng.choice(["", "\n", "\n\n"])))
    docs += [(80, None), (81, ""), (82, "\n"), (3, docs[3][1]), (None, docs[5][1])]
    check(spark.createDataFrame(docs, "doc_id long, text string").repartition(4))


def test_odd_rows(odd, nothing):
    check(odd, least_docs=2)
    assert lines.drop_repeated_lines(nothing).count() == 0
    clash = odd.withColumn("n_lines", F.lit("x")).withColumn("key", F.lit(1)).withColumn("place", F.lit(2))
    got = lines.drop_repeated_lines(clash)
    assert got.columns == [*odd.columns, "key", "place", "n_lines", "n_dropped"]
    assert got.count() == odd.count()


def test_main_path_is_native(odd):
    plan = lines.drop_repeated_lines(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_long_text_of_repeated_lines(spark):
    line = "the same line of more than forty characters, again"
    docs = [(i, "\n".join([line] * 3000)) for i in range(6)]
    check(spark.createDataFrame(docs, "doc_id long, text string"))
