from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.llm import spelling
from tidemark.llm.queries import QUERIES
from tidemark.llm.scratch import Scratch

from .conftest import SF_DIR, odd_rows, prose, table_of

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(rows, slips=97, least=3):
    n = Counter()
    for d, text in rows:
        for run in RUN.findall((text or "").translate(LOWER)):
            h = zlib.crc32(f"{d}:{run}".encode())
            if slips and d is not None and h % slips == 0:
                i = h % len(run)
                run = run[:i] + run[i + 1:]
            if len(run) >= 5:
                n[run] += 1
    n = {w: c for w, c in n.items() if c >= least}
    near = {w: [v for v in n if abs(len(v) - len(w)) < 2 and one_edit(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return [(w, n[w], len(near[w]), form[w], n[form[w]] if form[w] else None, root(w)) for w in n]


def check(spark, rows, **options):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = spelling.variants(df, **options).select("word", "n", "n_near", "form", "form_n", "root")
    assert sorted(table_of(got)) == sorted(brute(rows, options.get("slips", 97)))


def typed(rng, words, letters):
    """Words with typing errors, some of them several in a row, so that forms make chains."""
    out = []
    for _ in range(3000):
        w = words[min(int(rng.expovariate(0.15)), len(words) - 1)]
        while rng.random() < 0.4:
            i = rng.randrange(len(w))
            w = rng.choice([w[:i] + w[i + 1:], w[:i] + rng.choice(letters) + w[i:], w[:i] + rng.choice(letters) + w[i + 1:]])
        out.append(w.upper() if rng.random() < 0.1 else w)
    return " ".join(out)


@pytest.mark.parametrize("seed, letters", [(0, "abc"), (1, "etaoinéàÿß"), (2, "abcdefghijklmnopqrstuvwxyz×÷")])
def test_against_brute_force(spark, seed, letters):
    rng = random.Random(seed)
    words = ["".join(rng.choice(letters) for _ in range(rng.randrange(4, 11))) for _ in range(40)]
    rows = [(i, typed(rng, words, letters)) for i in range(4)]
    check(spark, rows + rows[:1])
    check(spark, rows, slips=5)


def test_chains_and_ties(spark):
    """Forms lead on to forms; of equally frequent neighbours the smallest is taken."""
    n = {"abcdef": 100, "abcdeg": 40, "abcdhg": 15, "abcihg": 7, "abjihg": 3, "lettera": 20, "letterb": 20, "letter": 5,
         "ÿÿÿÿÿ": 9, "zÿÿÿÿ": 9, "éÿÿÿÿ": 3, "lonely": 8, "almosta": 5, "almostb": 9}
    rows = [(None, " ".join(w for w, c in n.items() for _ in range(c)))]
    check(spark, rows)


def test_anagrams_are_not_near(spark):
    rows = [(None, "stale least slate tales steal " * 4)]
    check(spark, rows)
    assert all(r[2] == 0 for r in brute(rows))


def test_documents(spark, sf_docs):
    rows = table_of(sf_docs.select("doc_id", "text"))
    got = QUERIES["op11_spelling"](spark, SF_DIR).select("word", "n", "n_near", "form", "form_n", "root")
    assert sorted(table_of(got)) == sorted(brute(rows))


def test_odd_table(spark, odd, nothing):
    rows = [(r[0], r[1]) for r in odd_rows()] + [(20, "x" * 2000 + " " + "naïveté " * 5 + "naivete " * 11)]
    extra = spark.createDataFrame([(20, rows[-1][1], None, None, None)], odd.schema)
    clash = odd.union(extra).withColumn("word", F.lit("x")).withColumn("n", F.lit(1)).withColumn("run", F.lit(2))
    got = spelling.variants(clash).select("word", "n", "n_near", "form", "form_n", "root")
    assert sorted(table_of(got)) == sorted(brute(rows))
    assert spelling.variants(nothing).count() == 0


def test_classes_hold_each_letter_once(spark):
    words = spark.createDataFrame([("alphabet", 3), ("zebra", 3), ("été", 4)], "word string, n long")
    classes = spelling.letter_classes(words)
    assert sorted("".join(classes)) == sorted(set("alphabetzebraété")) and len(classes) == spelling.PARTS
    assert spelling.near_pairs(words, classes, Scratch(spark)).count() == 0
