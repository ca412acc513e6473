from __future__ import annotations

import pytest
from conftest import rows_of

from tidemark.operators import filters, quality, rows
from tidemark.operators.query import sql, table_or_sql


@pytest.fixture
def target(spark):
    return spark.createDataFrame([(1, "old", "x"), (2, "keep", "y"), (None, "n", "z")],
                                 "id int, val text, extra string".replace("text", "string"))


def _batch(spark, data):
    return spark.createDataFrame(data, "id int, val string")


def test_upsert_updates_inserts_and_keeps(spark, target):
    out = rows.upsert(target, _batch(spark, [(1, "new"), (3, "add"), (None, "n"), (None, "n")]),
                      "id")
    assert rows_of(out) == rows_of(spark.createDataFrame(
        [(1, "new", "x"), (2, "keep", "y"), (3, "add", None), (None, "n", "z"),
         (None, "n", None), (None, "n", None)], target.schema))


def test_upsert_is_idempotent(spark, target):
    batch = _batch(spark, [(1, "new"), (3, "add")])
    once = rows.upsert(target, batch, "id")
    assert rows_of(rows.upsert(once, batch, "id")) == rows_of(once)


def test_upsert_writes_explicit_null(spark, target):
    out = rows.upsert(target, _batch(spark, [(1, None)]), "id")
    assert (1, None, "x") in rows_of(out)


def test_upsert_of_chosen_columns(spark, target):
    batch = spark.createDataFrame([(1, "v", "e"), (9, "v", "e")], target.schema)
    out = rows_of(rows.upsert(target, batch, "id", ["extra"]))
    assert (1, "old", "e") in out and (9, "v", "e") in out


def test_upsert_rejects_duplicates_unless_told(spark, target):
    batch = _batch(spark, [(1, "a"), (1, "b")])
    with pytest.raises(Exception, match="touch a row twice"):
        rows.upsert(target, batch, "id").collect()
    last = rows.upsert(target, batch, "id", on_duplicate="last", order_by="val")
    assert (1, "b", "x") in rows_of(last)


def test_upsert_needs_something_to_update(spark, target):
    with pytest.raises(ValueError):
        rows.upsert(target, spark.createDataFrame([(1,)], "id int"), "id")


def test_delete_and_update_ignore_null_conditions(spark, target):
    assert len(rows_of(rows.delete_where(target, "id = 1"))) == 2
    assert ("n" in [r[1] for r in rows_of(rows.delete_where(target, "id > 0"))])
    out = rows_of(rows.update_where(target, {"val": "u"}, {"id": 2}))
    assert (2, "u", "y") in out and (1, "old", "x") in out
    for bad in ({}, ""):
        with pytest.raises(ValueError):
            rows.delete_where(target, bad)
    with pytest.raises(ValueError):
        rows.update_where(target, {}, {"id": 1})


def test_insert_ignore_adds_new_keys_once(spark, target):
    fresh = rows.insert_ignore(target, _batch(spark, [(1, "no"), (5, "b"), (5, "a"), (None, "c")]),
                               "id")
    assert rows_of(fresh) == [(5, "a", None), (None, "c", None)]


def test_align_rejects_unknown_columns(spark, target):
    with pytest.raises(ValueError):
        rows.align(spark.createDataFrame([(1, 2)], "id int, nope int"), target.schema)


def test_where_none_matches_nothing(target):
    assert filters.where_dict(target, {"id": None}).count() == 0
    assert filters.where_dict(target, {"id": 1, "extra": "x"}).count() == 1
    with pytest.raises(ValueError):
        filters.where_dict(target, {"nope": 1})


def test_raw_predicate_is_parenthesised(target):
    out = filters.raw_predicate(filters.raw_predicate(target, "id = 2"), "val = 'old' OR true")
    assert rows_of(out) == [(2, "keep", "y")]


def test_exists_and_paging(spark, target):
    assert filters.exists_rows(target, {"id": 2}).first().found is True
    assert filters.exists_rows(target, {"id": 7}).first().found is False
    with pytest.raises(ValueError):
        filters.exists_rows(target, {})
    page = filters.paginate(target, ["id"], 2, 1, descending=True)
    assert [r.id for r in page.collect()] == [2, 1]
    assert [r.id for r in filters.paginate(target, "id").collect()] == [1, 2, None]


def test_parent_delete_actions(spark):
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    child = spark.createDataFrame([(10, 1), (11, 2), (12, None)], "c int, p int")
    gone = {"id": 1}
    run = lambda action, **o: rows_of(rows.on_parent_delete(child, parent, gone, "p", "id",
                                                            action, **o))
    assert run("CASCADE") == [(11, 2), (12, None)]
    assert run("SET NULL") == [(10, None), (11, 2), (12, None)]
    assert run("set default", defaults={"p": 0}) == [(10, 0), (11, 2), (12, None)]
    assert run("RESTRICT") == [(1,)]
    with pytest.raises(ValueError):
        run("EXPLODE")


def test_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (None, "d"), (2, "e")],
                               "id int, v string")
    assert rows_of(quality.pk_violations(df, "id")) == [(1, 2), (None, 2)]
    assert rows_of(quality.unique_violations(df, "id")) == [(1, 2)]
    parent = spark.createDataFrame([(2,)], "id int")
    assert rows_of(quality.fk_orphans(df, parent, "id", "id")) == [(1, 2)]


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"), 1), (2.0, 2)], "x double, i int")
    assert rows_of(rows.nan_to_null(df)) == [(2.0, 2), (None, 1)]


def test_sql_with_both_parameter_forms(spark):
    df = spark.range(5)
    assert sql(spark, "SELECT id FROM {df} WHERE id > :a;", {"a": 3}, df=df).first().id == 4
    assert sql(spark, "SELECT id FROM {df} WHERE id = ?", [2], df=df).first().id == 2
    with pytest.raises(ValueError):
        table_or_sql(spark)
    assert filters.first_value(df.filter("id > 9")).count() == 0


def test_clean_steps(spark):
    df = spark.createDataFrame([(" A@X ",), (None,)], "email string")
    out = df.transform(rows.trim_lower("email")).transform(rows.drop_nulls("email"))
    assert rows_of(out) == [("a@x",)]


def test_column_profile_of_empty_table(spark):
    out = quality.column_profile(spark.createDataFrame([], "a int, b string"))
    assert rows_of(out) == [("a", 0, 0, 0, None, None), ("b", 0, 0, 0, None, None)]


def test_profile_estimates_in_one_pass(spark):
    out = quality.column_profile(spark.range(100).selectExpr("id % 4 AS k"), exact_distinct=False)
    assert rows_of(out) == [("k", 100, 0, 4, "0", "3")]


def test_rows_with_maps_upsert_and_insert(spark):
    schema = "id int, m map<string,int>"
    old = spark.createDataFrame([(1, {"a": 1}), (None, {"n": 0})], schema)
    batch = spark.createDataFrame([(1, {"b": 2}), (None, {"x": 1}), (None, {"x": 2})], schema)
    out = rows.upsert(old, batch, "id")
    assert sorted((r.id or 0, sorted(r.m.items())) for r in out.collect()) == [
        (0, [("n", 0)]), (0, [("x", 1)]), (0, [("x", 2)]), (1, [("b", 2)])]
    assert rows.insert_ignore(old, batch, "id").count() == 2


def test_replace_with_other_columns(spark, tables, name):
    tables.write(spark.createDataFrame([(1,)], "id int"), name)
    tables.write(spark.createDataFrame([("x", 2.0)], "a string, b double"), name, "replace")
    assert rows_of(tables.read(name)) == [("x", 2.0)]
