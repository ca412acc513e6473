"""Every registered query against its SQL in DuckDB."""

from __future__ import annotations

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import compare, duck

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def _names():
    from suite import QUERIES

    return sorted(QUERIES)


@pytest.mark.parametrize("query", _names())
def test_query(spark, con, query):
    ok, message, _ = compare(spark, con, query, SF_DIR, oracle_sql().get(query))
    assert ok, message


def test_entry(spark):
    assert entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())
