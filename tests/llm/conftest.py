from __future__ import annotations

import os
import random

import pytest

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def odd_rows():
    """Null and empty texts, nulls in every column, repeated rows, a long text, other alphabets."""
    rng = random.Random(3)
    long = "\n".join(prose(rng, 300) for _ in range(60))
    same = prose(rng, 80)
    return [
        (1, None, None, None, None), (2, "", "en", "a", 0), (3, " \t\r\n\x0b\x0c", "en", "a", 6),
        (4, same, "en", "a", 1), (5, same, "en", "b", 1), (5, same, "en", "b", 1),
        (6, long, "en", "b", 1), (7, long.upper(), None, None, 1), (8, "日本語 テスト ÄÖÜ ß İ\x00z", "ja", "é", 1),
        (9, same + " tail", "en", "a", 1), (None, "no id here", "en", "a", 1), (None, None, None, "a", None),
        (10, "one", "en", "a", 1), (11, "one two", "en", "z", 1), (12, long + "\n" + same, "en", "z", 1),
    ]


@pytest.fixture
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


@pytest.fixture
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def sf_docs(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


def table_of(df):
    return [tuple(r) for r in df.collect()]
