from __future__ import annotations

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import components, ngramjoin

from .conftest import prose, table_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def shingles(text, n=3):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def brute(docs, percent=90, n=3):
    sets = [shingles(t, n) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)), key=lambda k: docs[k][0])
                root[b] = a
    least = {}
    for i, (d, _) in enumerate(docs):
        least[find(i)] = min(d, least.get(find(i), d))
    return [(d, len(s), least[find(i)]) for i, ((d, _), s) in enumerate(zip(docs, sets))]


def edited(rng, text, edits):
    words = text.split()
    for _ in range(edits):
        i = rng.randrange(len(words))
        kind = rng.randrange(3)
        words[i:i + 1] = [f"n{rng.randrange(9999)}"] if kind == 0 else [] if kind == 1 else [words[i], "extra"]
    return " ".join(words)


def corpus(rng, bases=12, most=14):
    docs = []
    for b in range(bases):
        base = prose(rng, rng.choice([12, 30, 60, 200, 500]), 3000)
        for _ in range(rng.randrange(1, most)):
            docs.append(edited(rng, base, rng.randrange(max(2, len(base.split()) // 25))))
    docs += [docs[0]] * 5 + ["", " \t", "one", "one two", "ONE two", "a b c", "A B C"]
    rng.shuffle(docs)
    return list(enumerate(docs))


def check(spark, docs, percent=90):
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    assert sorted(table_of(ngramjoin.jaccard_components(df, percent=percent))) == sorted(brute(docs, percent))


@pytest.mark.parametrize("seed", range(3))
def test_against_brute_force(spark, seed):
    check(spark, corpus(random.Random(seed)))


def test_frequent_shingles_go_by_combinations(spark, monkeypatch):
    """Counters so few that every shingle counts as frequent, or as rare."""
    docs = corpus(random.Random(11), 8, 20)
    monkeypatch.setattr(ngramjoin, "frequencies", lambda given, n: np.full(1 << ngramjoin.SKETCH_BITS, 3, np.uint8))
    check(spark, docs)
    check(spark, docs, percent=80)


def test_keys_of_linked_sets_meet():
    """Whatever the frequencies, two sets at the threshold share a key."""
    rng = np.random.default_rng(5)
    for _ in range(400):
        n = int(rng.integers(9, 400))
        x = rng.integers(1, 1 << 62, n, dtype=np.uint64) * np.uint64(2)
        percent = int(rng.choice([80, 90]))
        y = x.copy()
        while True:  # edit while still linked
            z = np.unique(np.concatenate([rng.permutation(y)[:len(y) - int(rng.integers(0, 2))],
                                          rng.integers(1, 1 << 62, int(rng.integers(0, 2)), dtype=np.uint64)]))
            both = len(np.intersect1d(x, z))
            if 100 * both < percent * (len(x) + len(z) - both):
                break
            y = z
        frequent = lambda v: ((v >> np.uint64(7)) % np.uint64(3) * (v >> np.uint64(11)) % np.uint64(2)).astype(np.uint8)
        x, y = np.unique(x), np.unique(y)
        if len(x) == len(y) and (x == y).all():
            continue
        a, b = (ngramjoin._keys(v, frequent(v), percent) for v in (x, y))
        assert len(np.intersect1d(a, b))


def test_hot_group_of_near_copies(spark):
    rng = random.Random(13)
    base = prose(rng, 150, 3000)
    docs = [(i, edited(rng, base, rng.randrange(6))) for i in range(250)] + [(900 + i, prose(rng, 50, 3000)) for i in range(50)]
    check(spark, docs)


def test_chain_of_links(spark):
    """Each links only with its neighbours."""
    words = [f"w{i}" for i in range(130)]
    docs = [(i, " ".join(words[2 * i:2 * i + 90])) for i in range(20)]
    check(spark, docs)


def test_odd_rows(spark, odd, nothing):
    got = {(r["doc_id"], r["n_shingles"]): r["component_id"] for r in ngramjoin.jaccard_components(odd).collect()}
    assert got[1, 0] == 1 and got[2, 0] == 2 and got[3, 0] == 3 and got[5, 78] == 4 and got[9, 79] == 4
    assert got[7, len(shingles(odd.filter("doc_id = 6").first()["text"]))] == 6
    assert got[10, 1] == 10 and got[11, 1] == 11 and got[None, 1] is None
    assert ngramjoin.jaccard_components(odd).count() == odd.count()
    assert ngramjoin.jaccard_components(nothing).count() == 0
    clash = odd.withColumn("key", F.lit(1)).withColumn("size", F.lit(1)).withColumn("label", F.lit(1))
    kept = ngramjoin.one_per_component(clash)
    assert kept.columns == clash.columns
    assert sorted((r[0] is None, r[0] or 0) for r in kept.select("doc_id").collect()) == [
        *((False, i) for i in (1, 2, 3, 4, 6, 8, 10, 11)), (True, 0), (True, 0)]


def test_components_of_random_graphs(spark):
    rng = random.Random(17)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(400, x) for x in range(401, 450)]
    edges += [(500 + i, 501 + i) for i in range(60)]
    got = dict(table_of(components.connected(spark.createDataFrame(edges, "a long, b long"))))
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    assert got == {x: find(x) for e in edges for x in e if any(a != b and x in (a, b) for a, b in edges)}
    assert components.connected(spark.createDataFrame([], "a long, b long")).count() == 0
