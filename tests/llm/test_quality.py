from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")

from tidemark.llm import quality  # noqa: E402

from .conftest import SF_DIR, SCHEMA, prose, table_of  # noqa: E402

PATH = public_tokenizers.path("piece_bpe_32k.model")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    inside = {j for i in range(len(words) - 7) if windows[tuple(words[i:i + 8])] > 1 for j in range(i, i + 8)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(inside)


def counts_of(df):
    return df.select("doc_id", *quality._COUNTS)


def test_counts_against_brute_force(spark):
    rng = random.Random(6)
    docs = []
    for i in range(300):
        text = "".join(rng.choice([" ", "\n", "\n\n", "\t", " \r\n", "\x0b"]) + rng.choice(
            ["a", "b", "é#", "日本", "x|y", "<>", "$5", "word", prose(rng, 9, 3)]) for _ in range(rng.randrange(70)))
        docs.append((i, text, "en"))
    docs += [(900, None, "en"), (901, "", None), (902, "a " * 8, "en"), (903, "a " * 9, "en"), (904, "\n".join(["x y"] * 500), "en")]
    got = counts_of(quality.measured(spark.createDataFrame(docs, "doc_id long, text string, lang string"), PATH))
    assert sorted(table_of(got)) == sorted((i, *brute(t)) for i, t, _ in docs)


def test_counts_of_given_documents(sf_docs):
    got = counts_of(quality.measured(sf_docs, PATH))
    assert sorted(table_of(got)) == sorted((i, *brute(t)) for i, t in table_of(sf_docs.select("doc_id", "text")))


def test_measures(spark):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    text = "plain words and ☃ snow plain words"
    row = quality.measured(spark.createDataFrame([(1, text)], "doc_id long, text string"), PATH).first()
    ids = [i for w in text.split(" ") for i in model.encode(w)]
    assert row["chars_per_token"] == pytest.approx(len(text.replace(" ", "")) / len(ids))
    assert row["byte_share"] == pytest.approx(sum(map(model.is_byte, ids)) / len(ids))
    share = [n / len(ids) for n in Counter(ids).values()]
    assert row["token_entropy"] == pytest.approx(-sum(p * math.log2(p) for p in share) / math.log2(len(ids)))


def test_verdict(spark):
    """Ordinary documents stay; text the vocabulary knows only as bytes goes; base failures go."""
    rng = random.Random(9)
    common = "the of and to in a is that for it was with as on be at by this had not are but from or have an they".split()
    rows = [(i, " ".join(rng.choice(common) for _ in range(rng.randrange(60, 120))), "en", "a", 0) for i in range(300)]
    rows += [(1000 + i, " ".join("".join(chr(rng.randrange(0x12000, 0x12300)) for _ in range(4)) for _ in range(80)),
              "en", "a", 0) for i in range(5)]
    rows += [(2000, "too few words", "en", "a", 0), (2001, "one two three four five six seven eight " * 9, "en", "a", 0)]
    got = {r["doc_id"]: r["kept"] for r in quality.quality(spark.createDataFrame(rows, SCHEMA), PATH).collect()}
    assert all(got[i] for i in range(300))
    assert not any(got[1000 + i] for i in range(5)) and not got[2000] and not got[2001]


def test_junk_in_thin_cells_is_rejected(spark):
    """Alone at its length, in a rare language, or under a label of its own; ordinary text there stays."""
    rng = random.Random(19)
    common = "the of and to in a is that for it was with as on be at by this had not are but from or have an they".split()
    junk = lambda n: " ".join("".join(chr(rng.randrange(0x12000, 0x12300)) for _ in range(4)) for _ in range(n))
    plain = lambda n: " ".join(rng.choice(common) for _ in range(n))
    rows = [(i, plain(rng.randrange(60, 120)), "en", "a", 0) for i in range(300)]
    rows += [(1000, junk(20_000), "en", "a", 0), (1001, junk(80), "xx", "a", 0), (1002, junk(3000), None, "a", 0)]
    rows += [(2000, plain(90), "yy", "a", 0), (2001, plain(100), None, "a", 0)]
    got = {r["doc_id"]: r["kept"] for r in quality.quality(spark.createDataFrame(rows, SCHEMA), PATH).collect()}
    assert not any(got[i] for i in (1000, 1001, 1002))
    assert got[2000] and got[2001] and all(got[i] for i in range(300))


def test_clean_documents_stay(spark, sf_docs):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    got = quality.quality(sf_docs, PATH).join(labels.filter("quality = 1"), "doc_id").filter("NOT base_failed")
    assert got.filter("kept").count() >= 0.99 * got.count() > 0


def test_odd_rows(odd, nothing):
    got = quality.quality(odd.withColumn("n_words", F.lit("x")), PATH)
    assert got.count() == odd.count() and quality.quality(nothing, PATH).count() == 0
    assert sorted(map(repr, table_of(counts_of(got)))) == sorted(
        repr((i, *brute(t))) for i, t in table_of(odd.select("doc_id", "text")))
    assert not got.filter("doc_id = 1").first()["kept"]
    assert "text" not in quality.quality(odd, PATH, keep_text=False).columns
