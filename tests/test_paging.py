"""Deep pages found by counting equal those of a plain sort."""

from __future__ import annotations

import random

import pytest

from tidemark.operators import filters


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(3)
    data = [(i, rng.choice([None, "a", "b", "ä", ""]), rng.choice([None, float("nan"), -0.0, 0.0, 2.5, 1e300]),
             rng.choice([True, False, None]), rng.randrange(5)) for i in range(400)]
    return spark.createDataFrame(data, "id int, s string, d double, b boolean, k long").repartition(5).cache()


@pytest.mark.parametrize("keys", [["id"], ["s", "d", "id"], ["d", "b", "id"]])
@pytest.mark.parametrize("descending", [False, True])
def test_pages_equal_the_plain_sort(table, keys, descending):
    for offset, limit in [(37, 20), (398, 50), (400, 5), (900, 5)]:
        plain = filters.paginate(table, keys, limit, offset, descending=descending)
        deep = filters.paginate(table, keys, limit, offset, descending=descending, seek_from=6)
        assert [r.id for r in deep.collect()] == [r.id for r in plain.collect()]


def test_offset_is_brought_below_the_bound(table):
    for keys, descending in [(["id"], True), (["k", "id"], False)]:
        found, skip = filters._sought(table, keys, descending, 250, 10)
        assert skip <= 10 and found.count() == 400 - 250 + skip


def test_columns_that_cannot_be_cut_are_sorted(spark):
    df = spark.range(50).selectExpr("array(id) AS a", "id")
    got = filters.paginate(df, ["a"], 3, 40, seek_from=5).collect()
    assert [r.id for r in got] == [40, 41, 42]
    assert filters.paginate(df.limit(0), ["id"], 3, 40, seek_from=5).isEmpty()
