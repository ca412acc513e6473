from __future__ import annotations

import hashlib
import random

from tidemark.llm import suffixes

from .conftest import prose, table_of


def brute(docs, length=200):
    seen = {}
    for d, (_, text) in enumerate(docs):
        raw = (text or "").encode()
        for i in range(len(raw) - length + 1):
            seen.setdefault(raw[i:i + length], []).append((d, i))
    gone = [bytearray(len((t or "").encode())) for _, t in docs]
    for places in seen.values():
        if len(places) > 1:
            for d, i in places:
                gone[d][i:i + length] = b"\1" * length
    out = []
    for (key, text), flags in zip(docs, gone):
        raw = (text or "").encode()
        kept = bytes(b for b, g in zip(raw, flags) if not g)
        spans = sum(1 for i, g in enumerate(flags) if g and not (i and flags[i - 1]))
        out.append((key, len(raw), sum(flags), spans, hashlib.sha256(kept).hexdigest()))
    return out


def check(spark, docs, parts=3, length=200):
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(parts)
    assert sorted(map(repr, table_of(suffixes.removed_counts(df, length=length)))) == sorted(map(repr, brute(docs, length)))


def test_cover_is_a_difference_cover():
    assert {(a - b) % suffixes.V for a in suffixes.COVER for b in suffixes.COVER} == set(range(suffixes.V))


def test_planted_strings_of_every_offset_and_length(spark):
    rng = random.Random(1)
    shared = prose(rng, 400, 5000)
    docs = []
    for i in range(60):
        low, size = rng.randrange(1000), rng.choice([150, 199, 200, 201, 230, 300, 700])
        docs.append((i, prose(rng, rng.randrange(40), 5000) + shared[low:low + size] + prose(rng, rng.randrange(40), 5000)))
    check(spark, docs)


def test_exact_lengths(spark):
    rng = random.Random(2)
    for n in (199, 200, 201):
        same = "".join(rng.choice("abcdefgh") for _ in range(n))
        check(spark, [(1, "x" + same + "y"), (2, "zz" + same + "w"), (3, same)])


def test_periodic_texts_and_overlaps(spark):
    check(spark, [(1, "ab" * 150), (2, "a" * 250), (3, "é" * 130 + "x"), (4, "abc" * 67), (5, "q" * 199), (6, "ß" * 100)])


def test_edited_copies(spark):
    rng = random.Random(3)
    base = prose(rng, 300, 5000)
    docs = [(0, base)]
    for i in range(1, 25):
        words = base.split()
        for _ in range(rng.randrange(4)):
            words[rng.randrange(len(words))] = f"new{i}"
        docs.append((i, " ".join(words)))
    check(spark, docs)


def test_many_small_blocks_and_buckets(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "BLOCK", 2000)
    monkeypatch.setattr(suffixes, "BUCKET_BYTES", 5000)
    rng = random.Random(4)
    base = prose(rng, 100, 5000)
    docs = [(i, prose(rng, rng.randrange(80), 5000) + (base if i % 3 == 0 else "")) for i in range(60)]
    check(spark, docs)


def test_odd_rows(spark, odd, nothing):
    docs = table_of(odd.select("doc_id", "text"))
    got = suffixes.removed_counts(odd)
    assert sorted(map(repr, table_of(got))) == sorted(map(repr, brute(docs)))
    assert suffixes.removed_counts(nothing).count() == 0


def test_given_documents(spark, sf_docs):
    docs = table_of(sf_docs.select("doc_id", "text"))
    assert sorted(table_of(suffixes.removed_counts(sf_docs))) == sorted(brute(docs))
