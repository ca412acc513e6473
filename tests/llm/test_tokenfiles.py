from __future__ import annotations

import glob
import zlib

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

from tidemark.llm import tokenfiles, vocab  # noqa: E402

from .conftest import table_of  # noqa: E402

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD_TEXTS = ["", "İstanbul x.", "a,,b. c", "hello<|endoftext|>world", "<|ENDOFTEXT|> q", "it's. don't, X'S", "é́ é. ́x",
             "tab\tsep.\nnew\r\nline ,", "...", ".", "a.", "A,", "１２３ Σας ΣΑΣ. ŉ ß ÷a×", "日本語。テスト, ok.", "x" * 30000,
             "  two  spaces \n\n", "\x00 nul"]


def expected(docs):
    """``id, start, n, crc`` by whole-text encoding, in the order of ids."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(PATH)
    out, at = [], 0
    for i, text in docs:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        out.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def round_trip(df, **options):
    return sorted(table_of(tokenfiles.read_documents(tokenfiles.write_tokens(df, PATH, **options))), key=lambda r: r[1])


def test_round_trip_of_odd_texts(spark):
    docs = list(enumerate([*ODD_TEXTS, None]))
    df = spark.createDataFrame(docs[::-1], "doc_id long, text string").repartition(5)
    assert round_trip(df, length=64) == expected(docs)


def test_round_trip_of_given_documents(sf_docs):
    docs = sorted(table_of(sf_docs.select("doc_id", "text")))
    assert round_trip(sf_docs.repartition(6, "n_chars")) == expected(docs)


def test_small_tables_and_repeated_rows(spark, odd, nothing):
    assert round_trip(nothing) == []
    got = round_trip(odd)
    assert [r[0] for r in got] == [None, None, 1, 2, 3, 4, 5, 5, 6, 7, 8, 9, 10, 11, 12]
    assert got[0][1] == 0 and all(a[1] + a[2] == b[1] for a, b in zip(got, got[1:]))


def test_sequences_and_masks(sf_docs, tmp_path):
    files = tokenfiles.write_tokens(sf_docs, PATH, folder=f"file://{tmp_path}", length=128).collect()
    assert not glob.glob(f"{tmp_path}/_*")
    for row in files:
        file = tokenfiles.TokenFile(row["path"])
        assert file.length == 128
        whole = file.run(0, row["n_tokens"])
        tokens, masks = zip(*(file.sequence(i) for i in range(-(-row["n_tokens"] // 128))))
        masks, tokens = np.concatenate(masks), np.concatenate(tokens)
        assert masks.sum() == row["n_tokens"] and masks[:row["n_tokens"]].all()
        assert (tokens[:row["n_tokens"]] == whole).all()
        # a run inside one batch is a view of the mapped file
        assert not file.run(5, 100).flags.owndata


def test_table_is_emptied_when_full(monkeypatch):
    monkeypatch.setattr(vocab, "KNOWN_PARTS", 3)
    encoder = vocab.BpeEncoder(PATH)
    import pyarrow as pa

    from tidemark.llm import textkit
    for _ in range(3):
        for _, _, buf, bounds in textkit.slices(pa.array(["alpha beta gamma delta epsilon", "beta zeta"])):
            ids, sizes = encoder.encode(buf, bounds)
            assert ids.tolist() == [i for t in ("alpha beta gamma delta epsilon", "beta zeta")
                                    for i in encoder.tokenizer.encode(t, add_special_tokens=False).ids]
