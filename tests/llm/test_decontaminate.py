from __future__ import annotations

import random
import re


from tidemark.llm import decontaminate

from .conftest import SF_DIR, prose, table_of

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items, window=10):
    grams = {}
    for item, text in items:
        w = words(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            grams.setdefault(tuple(w[i:i + n]), set()).add(item)
    sizes = {len(g) for g in grams}
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in grams:
                    hit |= set(range(i, i + n))
                    found |= grams[tuple(w[i:i + n])]
        found.discard(None)
        out.append((doc, len(w), len(hit), len(found), sorted(found), bool(hit)))
    return out


def check(spark, docs, items, window=10):
    got = decontaminate.contamination(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string"), window=window)
    assert sorted(map(repr, table_of(got))) == sorted(map(repr, brute(docs, items, window)))


def test_against_brute_force(spark):
    rng = random.Random(1)
    items = [(i, prose(rng, rng.choice([1, 2, 5, 9, 10, 11, 30, 80]), 30 if i % 3 else 4000)) for i in range(40)]
    items += [(90, items[7][1]), (91, None), (92, ""), (93, "  .,!"), (None, prose(rng, 20))]
    docs = []
    for i in range(120):
        parts = [prose(rng, rng.randrange(60), 30 if i % 4 == 0 else 4000)]
        for _ in range(rng.randrange(4)):
            w = words(items[rng.randrange(40)][1])
            low = rng.randrange(len(w))
            parts += [" ".join(w[low:low + rng.randrange(1, 40)]).upper(), prose(rng, rng.randrange(30), 4000)]
        docs.append((i, " ,\n".join(parts)))
    docs += [(500, None), (501, ""), (None, docs[3][1]), (3, docs[3][1]), (3, docs[3][1])]
    check(spark, docs, items)
    check(spark, docs, items, window=7)


def test_every_run_of_a_window_is_found(spark):
    """A shared run of exactly one window, at every offset, in texts with few words (many ties)."""
    rng = random.Random(2)
    item = prose(rng, 60, 3)
    w = item.split()
    docs = [(i, " ".join(["x", *w[i:i + 10], "y"])) for i in range(51)]
    docs += [(100 + i, " ".join(["x", *w[i:i + 9], "y"])) for i in range(52)]
    check(spark, docs, [(1, item)])


def test_odd_rows(spark, odd, nothing):
    items = spark.createDataFrame([(1, odd.filter("doc_id = 4").first()["text"], "x")], "item_id long, text string, doc_id string")
    rows = {(r["doc_id"], r["n_words"]): r for r in decontaminate.contamination(odd, items).collect()}
    assert rows[4, 80]["n_hit"] == 80 and rows[9, 81]["n_hit"] == 80 and rows[1, 0]["n_hit"] == 0
    assert decontaminate.contamination(odd, items).count() == odd.count()
    assert decontaminate.contamination(nothing, items).count() == 0
    clean = decontaminate.contamination(odd, items.limit(0))
    assert clean.filter("contaminated").count() == 0 and clean.count() == odd.count()
    kept = decontaminate.drop_contaminated(odd, items)
    assert kept.columns == odd.columns
    assert {r[0] for r in kept.select("doc_id").collect()} == {1, 2, 3, 6, 7, 8, 10, 11, None}


def test_spans(spark):
    item = " ".join(f"q{i}" for i in range(30))
    docs = spark.createDataFrame([(1, f"a b {item} c {item[:69]}")], "doc_id long, text string")
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    row = decontaminate.contaminated_spans(docs, items).first()
    assert [tuple(s) for s in row["spans"]] == [(2, 32), (33, 53)]


def test_given_tables(spark, sf_docs):
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    got = decontaminate.contamination(sf_docs, items)
    want = brute(table_of(sf_docs.select("doc_id", "text")), table_of(items.select("item_id", "text")))
    assert sorted(table_of(got)) == sorted(want)
