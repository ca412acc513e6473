"""Tables dealt to segments by key: what a change rewrites, and that it equals a change of the whole table."""

from __future__ import annotations

import datetime as dt
import os
import random

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from tidemark.operators import rows
from tidemark.plans.etl import Etl, Pipeline
from tidemark.sources import segments
from tidemark.sources.segments import SEGMENT, KeyedTable
from tidemark.streaming import jobs

SCHEMA = "id int, part string, val string, n long"


def _frame(spark, data, schema=SCHEMA):
    return spark.createDataFrame(data, schema)


def _files(spark, name):
    """Path, time and segment of every file."""
    found = spark.table(name).select("_metadata.file_path", "_metadata.file_modification_time", SEGMENT).distinct()
    return {tuple(r) for r in found.collect()}


@pytest.fixture
def keyed(spark, tables, name):
    data = [(i, "ab"[i % 2], f"v{i}", i) for i in range(200)] + [(None, "a", "none", None)]
    assert tables.create_keyed(_frame(spark, data), name, "id", 16) == 201
    return tables


def test_untouched_segments_keep_their_files(spark, keyed, name):
    before = _files(spark, name)
    assert keyed.upsert(_frame(spark, [(3, "z", "new", 1), (1000, "z", "add", 2)]), name, "id") == 2
    after = _files(spark, name)
    touched = {s for _, _, s in after - before}
    assert 1 <= len(touched) <= 2
    assert {f for f in before if f[2] not in touched} == {f for f in after if f[2] not in touched}
    # the old files of the touched segments are gone
    assert not any(os.path.exists(p.removeprefix("file:")) for p, _, s in before if s in touched)

    before = after
    assert keyed.delete(name, {"id": 7}) == 1
    assert len({s for _, _, s in _files(spark, name) - before}) == 1
    before = _files(spark, name)
    assert keyed.update(name, {"val": "u"}, {"id": 8}) == 1
    assert len({s for _, _, s in _files(spark, name) - before}) == 1
    before = _files(spark, name)
    assert keyed.delete(name, {"id": 5000}) == 0 and keyed.update(name, {"val": "u"}, "n < 0") == 0
    assert keyed.upsert(_frame(spark, []), name, "id") == 0
    assert _files(spark, name) == before
    got = {r.id: r.val for r in keyed.read(name).collect()}
    assert (got[3], got[1000], got[8], got[None], len(got)) == ("new", "add", "u", "none", 201) and 7 not in got
    assert SEGMENT not in keyed.read(name).columns


def test_random_changes_equal_those_of_a_plain_table(spark, tables, name):
    rng, plain = random.Random(5), name + "_plain"
    schema = "a long, b string, v string"
    data = [(rng.choice([None, *range(12)]), rng.choice([None, "x", "y"]), f"{i}") for i in range(40)]
    data = list({d[:2]: d for d in data}.values())
    tables.create_keyed(_frame(spark, data, schema), name, ["a", "b"], 8)
    tables.write(_frame(spark, data, schema), plain)
    for step in range(6):
        # an int key against a long one, keys that are new, known and NULL, every row once
        batch = list({k: (*k, f"s{step}") for k in [(rng.choice([None, *range(20)]), rng.choice([None, "x", "z"]))
                                                  for _ in range(5)]}.values())
        change = _frame(spark, batch, "a int, b string, v string")
        options = {"match_nulls": bool(step % 2)}
        assert tables.upsert(change, name, ["a", "b"], **options) == tables.upsert(change, plain, ["a", "b"], **options)
        where, values = [("a % 5 = 1", {"b": "moved"}), ({"a": step, "b": "x"}, {"v": "w"}), ("b IS NULL", {"a": 99})][step % 3]
        assert tables.update(name, values, where) == tables.update(plain, values, where)
        gone = [{"a": step + 3, "b": "x"}, "a > 15", {"b": "z"}][step % 3]
        assert tables.delete(name, gone) == tables.delete(plain, gone)
        assert tables.insert_ignore(change, name, ["a", "b"]) == tables.insert_ignore(change, plain, ["a", "b"])
        assert rows_of(tables.read(name)) == rows_of(tables.read(plain))
        # every row lies in the segment of its key
        table = KeyedTable.of(spark, name)
        assert spark.table(name).filter(F.col(SEGMENT) != table._segment(spark.table(name))).isEmpty()


def test_other_keys_rewrite_everything_and_place_rows_anew(spark, tables, name):
    tables.create_keyed(_frame(spark, [(1, "a", "x", 0), (2, "b", "y", 0)]), name, "id", 8)
    assert tables.upsert(_frame(spark, [(50, "a", "new", 1)]), name, "part") == 1
    assert tables.delete(name, {"id": 50}) == 1
    assert rows_of(tables.read(name)) == [(2, "b", "y", 0)]


def test_failure_leaves_the_rows(spark, keyed, name):
    before, rows_before = _files(spark, name), rows_of(keyed.read(name))
    broken = _frame(spark, [(3, "z", "new", 1)]).withColumn("val", F.raise_error(F.lit("boom")).cast("string"))
    with pytest.raises(Exception, match="boom"):
        keyed.upsert(broken, name, "id")
    with pytest.raises(Exception, match="twice"):
        keyed.upsert(_frame(spark, [(3, "z", "a", 1), (3, "z", "b", 1)]), name, "id")
    with pytest.raises(ValueError):
        keyed.append(_frame(spark, [(1, 2)], "id int, other int"), name)
    assert _files(spark, name) == before and rows_of(keyed.read(name)) == rows_before


def test_batch_that_changes_between_reads_is_refused(spark, keyed, name, monkeypatch):
    rows_before = rows_of(keyed.read(name))
    monkeypatch.setattr(KeyedTable, "_segments_of", lambda self, df: {0})
    with pytest.raises(RuntimeError, match="nothing was changed"):
        keyed.upsert(_frame(spark, [(i, "z", "new", 1) for i in range(40)]), name, "id")
    assert rows_of(keyed.read(name)) == rows_before


def test_lookups_open_the_segments_of_the_batch(spark, keyed, name):
    batch = _frame(spark, [(3, "z", "q", 1)])
    near = keyed.near(batch, name, "id")
    files = near.select(F.input_file_name().alias("f")).distinct().count()
    assert near.filter("id = 3").count() == 1 and files < len(_files(spark, name)) / 4
    assert keyed.near(batch, name, "part").count() == 201


def test_replace_truncate_and_empty_segments(spark, keyed, name):
    assert keyed.delete(name, "id IS NOT NULL OR id IS NULL") == 201
    assert keyed.read(name).isEmpty() and spark.sql(f"SHOW PARTITIONS {name}").isEmpty()
    assert keyed.append(_frame(spark, [(1, "a", "x", 0)]), name) == 1
    assert keyed.write(_frame(spark, [(2, "a", "x", 0), (3, "b", "y", None)]), name, "replace") == 2
    assert rows_of(keyed.read(name)) == [(2, "a", "x", 0), (3, "b", "y", None)]
    assert keyed.keyed(name).segments == 16
    keyed.truncate(name)
    assert keyed.read(name).isEmpty() and keyed.keyed(name) is not None
    # other columns make another, plain table
    keyed.write(_frame(spark, [(2,)], "k int"), name, "replace")
    assert rows_of(keyed.read(name)) == [(2,)] and keyed.keyed(name) is None


def test_rejected_definitions(spark, tables, name):
    df = _frame(spark, [])
    for keys, count in [([], 4), ("absent", 4), ("id", 0), ("id", segments.MOST_SEGMENTS + 1), ("id", True)]:
        with pytest.raises(ValueError):
            tables.create_keyed(df, name, keys, count)
    with pytest.raises(ValueError, match="segment column"):
        tables.create_keyed(df.withColumn(SEGMENT, F.lit(1)), name, "id", 4)
    assert tables.create_keyed(df, name, "id", 4) == 0
    with pytest.raises(ValueError, match="exists"):
        tables.create_keyed(df, name, "id", 4)


def test_odd_names_and_values(spark, tables, name):
    schema = "`it's` timestamp, `a\\b` double"
    data = [(dt.datetime(2024, 1, d), float(d)) for d in range(1, 6)]
    tables.create_keyed(_frame(spark, data, schema), name, ["it's"], 4)
    assert tables.delete(name, {"it's": dt.datetime(2024, 1, 2)}) == 1
    assert tables.upsert(_frame(spark, [(dt.datetime(2024, 1, 3), 9.0)], schema), name, "it's") == 1
    assert rows_of(tables.read(name).select("a\\b")) == [(1.0,), (4.0,), (5.0,), (9.0,)]
    assert tables.delete(name, {"it's": None}) == 0


def test_pipelines_and_streams_rewrite_segments(spark, keyed, name, tmp_path):
    source = name + "_source"
    batch = _frame(spark, [(3, "z", "new", 900), (777, "z", "add", 901)])
    batch.createOrReplaceTempView(source)
    etl, before = Etl(keyed, name + "_runs"), _files(spark, name)
    load = Pipeline("segments", source, name, "upsert", ("id",), incremental_column="n")
    done = etl.run(load)
    assert (done.rows_extracted, done.rows_loaded, done.watermark_recorded) == (2, 2, 901)
    assert 1 <= len({s for _, _, s in _files(spark, name) - before}) <= 2
    before = _files(spark, name)
    assert etl.run(load).rows_loaded == 0 and _files(spark, name) == before
    assert etl.run(Pipeline("more", source, name, "append")).rows_loaded == 2
    assert keyed.read(name).filter("id IN (3, 777)").count() == 4
    assert etl.run(Pipeline("all", source, name, "replace")).rows_loaded == 2
    assert rows_of(keyed.read(name)) == rows_of(batch)

    _frame(spark, [(3, "s", "older", 1), (4, "s", "fresh", 5)]).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in"))
    jobs.maintain_rows(stream, keyed, name, "id", "n", str(tmp_path / "at")).awaitTermination()
    assert {r.id: r.val for r in keyed.read(name).collect()} == {3: "new", 777: "add", 4: "fresh"}


def test_upsert_equals_the_frame_operator(spark, tables, name):
    old = spark.range(500).select(F.col("id"), (F.col("id") * 3).alias("v"), F.lit("k").alias("kept"))
    batch = spark.range(450, 600, 7).select(F.col("id"), F.lit(-1).cast("long").alias("v"))
    tables.create_keyed(old, name, "id", 32)
    tables.upsert(batch, name, "id", ["v"])
    assert rows_of(tables.read(name)) == rows_of(rows.upsert(old, batch, "id", ["v"]))


def test_a_column_named_location(spark, tables, name):
    schema = "Location string, k int"
    tables.create_keyed(_frame(spark, [("x", 1), ("y", 2)], schema), name, "k", 2)
    assert tables.upsert(_frame(spark, [("z", 1)], schema), name, "k") == 1
    assert rows_of(tables.read(name)) == [("y", 2), ("z", 1)]
