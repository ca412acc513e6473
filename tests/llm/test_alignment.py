from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import alignment
from tidemark.llm.queries import QUERIES, vocabulary

from .conftest import SF_DIR, odd_rows, prose, table_of

A, B = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def a_bytes(token, table):
    return bytes(table[c] for c in token)


def b_bytes(piece):
    found = re.fullmatch("<0x([0-9A-F]{2})>", piece)
    return bytes([int(found[1], 16)]) if found else piece.replace("▁", " ").encode()


def groups_of(text, libraries, table):
    """Groups of ids of the whole text, token by token."""
    a, b = libraries
    want = (" " + (text or "")).encode()
    left = a.encode(" " + text, add_special_tokens=False).ids if text else []
    right = b.encode(text) if text else []
    left = [(i, a_bytes(a.id_to_token(i), table)) for i in left]
    right = [(i, b_bytes(b.id_to_piece(i))) for i in right]
    if not text or any(b"".join(x for _, x in side) != want for side in (left, right)):
        return []
    ends = [set(np.cumsum([len(x) for _, x in side]).tolist()) for side in (left, right)]
    both, out = sorted(ends[0] & ends[1]), []
    at = [0, 0]
    position = [0, 0]
    for end in both:
        group = ([], [])
        for k, side in enumerate((left, right)):
            while position[k] < end:
                i, x = side[at[k]]
                group[k].append(i)
                position[k] += len(x)
                at[k] += 1
        out.append(group)
    return out


def brute(rows, libraries):
    table = alignment._unicode_to_byte()
    found = [(d, groups_of(t, libraries, table)) for d, t in rows]
    counts = Counter((x[-1], y[-1]) for _, groups in found for x, y in groups)
    best = Counter()
    for (_, j), n in counts.items():
        best[j] = max(best[j], n)
    out = []
    for d, groups in found:
        links = [(x[-1], y[-1]) for x, y in groups]
        text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        out.append((d, sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), len(links),
                    sum(counts[k] == best[k[1]] for k in links), sum(counts[k] for k in links),
                    hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return out


def check(spark, rows, libraries):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = table_of(alignment.align(df, A, B))
    assert sorted(got, key=str) == sorted(brute(rows, libraries), key=str)


ODD_TEXTS = ["a  b", " a", "a ", "a \n", "\n", "\n\nx", "x\n\ny\n", "x \n y", "tab\there", "a▁b", "<|endoftext|> <s></s>",
             "<0x41> <unk>", "日本語 テスト", "café Été naïve\nÉ", " x   y  z", " em 　wide",
             "can't won't it's 'll", "12345 6.78 1,000", "a\r\nb\r\n", "\x00 \x1c \x85 x", "é ́x", "\U0001f600 ok\U0001f600 \U0001f600",
             "  ", " ", "x" * 300, "()) ;\r}\r", "ﬁn ´ Å"]


def test_odd_texts(spark, libraries):
    check(spark, list(enumerate(ODD_TEXTS)) + [(None, "a  b"), (7, "a  b"), (8, None), (9, "")], libraries)


@pytest.mark.parametrize("seed", range(2))
def test_random_texts(spark, libraries, seed):
    rng = random.Random(seed)
    alphabet = ["a", "be", "The", " ", " ", "  ", "\n", "'s", ".", ",", "é", "ß", "9", "42", "\t", " ", "’", "中", "-", "\r"]
    rows = [(i, "".join(rng.choice(alphabet) for _ in range(rng.randrange(60)))) for i in range(200)]
    check(spark, rows + rows[:20], libraries)


def test_documents(spark, sf_docs, libraries):
    rows = table_of(sf_docs.select("doc_id", "text"))
    got = QUERIES["op13_alignment"](spark, SF_DIR)
    assert sorted(table_of(got), key=str) == sorted(brute(rows, libraries), key=str)


def test_odd_table(spark, odd, nothing, libraries):
    rows = [(r[0], r[1]) for r in odd_rows()]
    clash = odd.withColumn("digest", F.lit(1)).withColumn("n_a", F.lit(2)).withColumn("id", F.lit("x"))
    for df in (odd, clash):
        assert sorted(table_of(alignment.align(df, A, B)), key=str) == sorted(brute(rows, libraries), key=str)
    assert alignment.align(nothing, A, B).count() == 0


def test_small_blocks_and_a_full_table(libraries, monkeypatch):
    """Long rows are spelled out in blocks, and a full table of parts is emptied."""
    monkeypatch.setattr(alignment, "BLOCK_PARTS", 7)
    monkeypatch.setattr(alignment, "KNOWN_PARTS", 30)
    rng = random.Random(5)
    texts = [prose(rng, n) for n in (1, 40, 3, 25, 2)] + ["x▁", prose(rng, 9)]
    pairs = alignment.PairList(alignment.byte_tokens(A), alignment.piece_tokens(B))
    tools, table = alignment.Encoders(A, B), alignment._unicode_to_byte()
    for _ in range(3):
        data = [t.encode() for t in texts]
        bounds = np.concatenate([[0], np.cumsum([len(x) for x in data])])
        numbers, digests, links, _ = tools.align(np.frombuffer(b"".join(data), np.uint8), bounds, pairs.keys, pairs.width)
        for i, t in enumerate(texts):
            groups = groups_of(t, libraries, table)
            assert numbers[2][i] == len(groups)
            text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
            assert digests[i] == (hashlib.sha256(text.encode()).hexdigest() if groups else "")
        want = [(x[-1] * pairs.width + y[-1]) for t in texts for x, y in groups_of(t, libraries, table)]
        assert pairs.keys[links].tolist() == want
        rng.shuffle(texts)


def test_pairs_are_bounded():
    """Every listed pair is one token that ends with the other."""
    a, b = alignment.byte_tokens(A), alignment.piece_tokens(B)
    pairs = alignment.PairList(a, b)
    assert len(pairs.keys) <= 2 * (sum(map(len, a)) + sum(map(len, b)))
    for key in pairs.keys[::997].tolist():
        x, y = a[key // len(b)], b[key % len(b)]
        assert x.endswith(y) or y.endswith(x)
