from __future__ import annotations

import datetime as dt
import uuid

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from tidemark.operators import timeseries as ts
from tidemark.plans import etl as E
from tidemark.plans.cagg import ContinuousAggregate, Materialization, policy_window
from tidemark.plans.etl import Etl, Pipeline
from tidemark.plans.runlog import EtlError, mark_column
from tidemark.sources.chunks import ChunkedTable
from tidemark.streaming import feeds, jobs

T0 = dt.datetime(2024, 1, 1)


# --- continuous aggregates --------------------------------------------------------

@pytest.fixture
def source(spark, tables, name):
    df = spark.createDataFrame(
        [(T0 + dt.timedelta(hours=h), float(h)) for h in range(0, 24 * 8, 3)],
        "ts timestamp_ntz, val double")
    tables.write(df, name + "_src")
    return name + "_src"


def _cagg(spark, tables, name, source, **options):
    of = ContinuousAggregate(name, lambda s: s.table(source), "ts", "6 hours",
                             {"n": F.count(F.lit(1)), "top": "max(val)"}, chunk_interval="1 day",
                             **options)
    return Materialization(spark, of)


def test_refresh_replaces_only_whole_buckets_of_the_window(spark, tables, name, source, tmp_path):
    job = _cagg(spark, tables, name, source).create(str(tmp_path / "c"))
    assert job.stored().count() == 32
    tables.update(source, {"val": -1.0}, "true")
    job.refresh(T0 + dt.timedelta(hours=7), T0 + dt.timedelta(hours=25))
    changed = [r.bucket for r in job.stored().filter("top = -1").orderBy("bucket").collect()]
    assert changed == [T0 + dt.timedelta(hours=h) for h in (12, 18)]
    assert job.stored().count() == 32


def test_refresh_forgets_buckets_without_rows(spark, tables, name, source, tmp_path):
    job = _cagg(spark, tables, name, source).create(str(tmp_path / "c"))
    tables.delete(source, "ts >= timestamp_ntz'2024-01-03' and ts < timestamp_ntz'2024-01-04'")
    tables.delete(source, "ts >= timestamp_ntz'2024-01-05' and ts < timestamp_ntz'2024-01-05 06:00'")
    job.refresh(None, None)
    assert job.stored().count() == 32 - 4 - 1
    assert rows_of(job.stored()) == rows_of(job.of.aggregate(spark.table(source)))


def test_realtime_read_adds_newer_rows(spark, tables, name, source, tmp_path):
    job = _cagg(spark, tables, name, source, materialized_only=False)
    job.create(str(tmp_path / "c"), with_no_data=True)
    assert job.horizon() is None
    assert job.read().count() == 32
    job.refresh(None, T0 + dt.timedelta(days=4))
    assert job.horizon() == T0 + dt.timedelta(days=4)
    assert job.stored().count() == 16 and job.read().count() == 32


def test_refresh_arguments(spark, tables, name, source):
    job = _cagg(spark, tables, name, source)
    with pytest.raises(TypeError):
        job.refresh("2024-01-01", None)
    with pytest.raises(ValueError):
        job.refresh(T0, T0)
    with pytest.raises(ValueError):
        policy_window("1 hour", "1 day", T0)
    assert policy_window(None, "1 day", T0) == (None, T0 - dt.timedelta(days=1))
    assert policy_window("1 month", "1 day", T0)[0] == dt.datetime(2023, 12, 1)


# --- pipelines --------------------------------------------------------------------

@pytest.fixture
def etl(tables, name):
    return Etl(tables, name + "_runs")


def _load(etl, name, data, schema="id int, val string"):
    etl.tables.write(etl.spark.createDataFrame(data, schema), name, "replace")


def test_descriptor_checks():
    for bad in ({"name": ""}, {"load_mode": "merge"}, {"load_mode": "upsert"},
                {"extract_limit": 0}, {"extract_limit": True}, {"incremental_column": "id"}):
        with pytest.raises(ValueError):
            Pipeline(**{"name": "p", "source": "s", "target": "t", **bad})
    assert Pipeline("p", "SELECT 1", "t").source_is_query
    assert Pipeline("p", "with x as (select 1) select * from x", "t").source_is_query
    assert not Pipeline("p", "selected_rows", "t").source_is_query


def test_append_needs_a_target_and_counts(etl, name):
    _load(etl, name, [(1, "a"), (2, None)])
    with pytest.raises(EtlError, match="does not exist"):
        etl.run(Pipeline("p", name, name + "_t"))
    _load(etl, name + "_t", [(9, "z")])
    result = etl.run(Pipeline("p", f"SELECT * FROM {name};", name + "_t"))
    assert (result.status, result.rows_extracted, result.rows_loaded) == ("success", 2, 2)
    assert etl.tables.read(name + "_t").count() == 3
    history = etl.history("p").collect()
    assert [r.status for r in history] == ["success", "failed"]
    assert "does not exist" in history[1].error_message and history[1].error_traceback
    assert etl.last_run("p").first().run_id == result.run_id
    assert etl.last_run("never").count() == 0


def test_failed_replace_leaves_the_target(etl, name):
    _load(etl, name, [(1, "a")])
    _load(etl, name + "_t", [(9, "z")])

    def broken(df):
        return df.withColumn("val", F.raise_error(F.lit("boom")).cast("string"))

    with pytest.raises(Exception, match="boom"):
        etl.run(Pipeline("p", name, name + "_t", "replace", transform=broken))
    assert rows_of(etl.tables.read(name + "_t")) == [(9, "z")]
    assert etl.last_run("p").first().status == "failed"


def test_empty_result_leaves_the_target(etl, name):
    _load(etl, name, [(1, "a")])
    _load(etl, name + "_t", [(9, "z")])
    result = etl.run(Pipeline("p", name, name + "_t", "replace",
                              transform=lambda df: df.filter("id > 5")))
    assert (result.status, result.rows_extracted, result.rows_loaded) == ("success", 1, 0)
    assert rows_of(etl.tables.read(name + "_t")) == [(9, "z")]


def test_transform_failure_names_the_step(etl, name):
    _load(etl, name, [(1, "a")])

    def second(df):
        raise KeyError("nope")

    with pytest.raises(EtlError, match=r"step 2 \(second\)"):
        etl.run(Pipeline("p", name, name + "_t", "replace", transform=[lambda df: df, second]))
    with pytest.raises(EtlError, match="did not return"):
        E.transformed(etl.tables.read(name), [lambda df: None])


def test_incremental_upsert_over_runs(etl, name):
    _load(etl, name, [(1, "a", 10), (2, "b", 20)], "id int, val string, wm int")
    _load(etl, name + "_t", [(1, "old", 0)], "id int, val string, wm int")
    load = Pipeline("p", name, name + "_t", "upsert", ("id",), incremental_column="wm")
    first = etl.run(load)
    assert (first.watermark_used, first.watermark_recorded, first.rows_loaded) == (None, 20, 2)
    # boundary rows are not extracted again
    assert etl.run(load).rows_extracted == 0
    # a batch without marks keeps the recorded one
    _load(etl, name, [(3, "c", None)], "id int, val string, wm int")
    again = etl.run(load)
    assert (again.watermark_used, again.rows_extracted) == (20, 0)
    _load(etl, name, [(1, "z", 30), (4, "d", 20)], "id int, val string, wm int")
    third = etl.run(load)
    assert (third.watermark_used, third.watermark_recorded) == (20, 30)
    assert rows_of(etl.tables.read(name + "_t")) == [(1, "z", 30), (2, "b", 20)]


def test_mark_is_of_the_raw_batch(etl, name):
    _load(etl, name, [(1, "a", 10), (2, "b", 99)], "id int, val string, wm int")
    _load(etl, name + "_t", [(1, "old", 0)], "id int, val string, wm int")
    result = etl.run(Pipeline("p", name, name + "_t", "upsert", ("id",),
                              transform=lambda df: df.filter("id = 1"), incremental_column="wm"))
    assert (result.watermark_recorded, result.rows_extracted, result.rows_loaded) == (99, 2, 1)


@pytest.mark.parametrize("kind,value", [
    ("timestamp_ntz", T0), ("string", "m"), ("bigint", 7),
    ("timestamp", dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc))])
def test_mark_types_round_trip(etl, name, kind, value):
    _load(etl, name, [(1, value)], f"id int, wm {kind}")
    _load(etl, name + "_t", [], f"id int, wm {kind}")
    load = Pipeline("p", name, name + "_t", "upsert", ("id",), incremental_column="wm")
    assert etl.run(load).watermark_recorded == value
    second = etl.run(load)
    assert second.watermark_used == value and second.rows_extracted == 0


def test_fractional_marks_are_refused(etl, name):
    _load(etl, name, [(1, 99.99)], "id int, wm double")
    _load(etl, name + "_t", [], "id int, wm double")
    with pytest.raises(EtlError, match="must be a timestamp"):
        etl.run(Pipeline("p", name, name + "_t", "upsert", ("id",), incremental_column="wm"))
    for bad in (1.5, True):
        with pytest.raises(EtlError):
            mark_column(bad)
    assert [mark_column(v) for v in (T0, 3, "x")] == ["watermark_time", "watermark_number", "watermark_text"]


def test_limited_runs_catch_up_whatever_the_order(etl, name):
    """The limit follows the mark with its ties, so no row is left below a recorded mark."""
    data = [(i, f"v{i}", (i * 37) % 50) for i in range(200)] + [(900, "no mark", None)]
    _load(etl, name, data, "id int, val string, wm int")
    _load(etl, name + "_t", [], "id int, val string, wm int")
    load = Pipeline("p", name, name + "_t", "upsert", ("id",), incremental_column="wm", extract_limit=30)
    loads = [etl.run(load).rows_loaded for _ in range(9)]
    assert loads[0] == 33 and sum(loads) == 201 and loads[-1] == 0
    assert rows_of(etl.tables.read(name + "_t")) == rows_of(etl.tables.read(name))


def test_raw_count_with_a_sorting_step(etl, name):
    _load(etl, name, [(i, "x") for i in range(5000)])
    result = etl.run(Pipeline("p", name, name + "_t", "replace", transform=lambda df: df.orderBy("id")))
    assert (result.rows_extracted, result.rows_loaded) == (5000, 5000)
    dry = etl.run(Pipeline("p", name, name + "_u", "replace", transform=lambda df: df.orderBy("id")), dry_run=True)
    assert dry.rows_extracted == 5000


def test_runs_without_news_write_nothing(etl, name):
    import os

    _load(etl, name, [(1, "a", 10)], "id int, val string, wm int")
    _load(etl, name + "_t", [], "id int, val string, wm int")
    load = Pipeline("p", name, name + "_t", "upsert", ["id"], incremental_column="wm")
    etl.run(load)
    folder = f"{etl.tables.root}/{name}_t"
    before = sorted(os.listdir(folder))
    for _ in range(3):
        assert etl.run(load).rows_loaded == 0
    assert sorted(os.listdir(folder)) == before


def test_step_that_fails_while_rows_are_written_is_named(etl, name):
    _load(etl, name, [(1, "a")])

    def late(df):
        return df.withColumn("val", F.raise_error(F.lit("boom")).cast("string"))

    with pytest.raises(EtlError, match=r"step 2 \(late\) failed.*boom"):
        etl.run(Pipeline("p", name, name + "_t", "replace", transform=[lambda df: df, late]))
    assert "boom" in etl.last_run("p").first().error_message


def test_conflict_columns_as_text_are_refused():
    with pytest.raises(ValueError, match="list of names"):
        Pipeline("p", "s", "t", "upsert", "id")


def test_dry_run_writes_nothing(etl, name):
    _load(etl, name, [(1, "a"), (2, "b")])
    result = etl.run(Pipeline("p", name, name + "_t", "replace"), dry_run=True)
    assert (result.status, result.run_id, result.rows_extracted, result.rows_loaded) == (
        "dry_run", None, 2, 0)
    assert not etl.tables.exists(name + "_t") and not etl.tables.exists(name + "_runs")


def test_nan_is_loaded_as_null(etl, name):
    _load(etl, name, [(1, 1.5), (2, 2.5)], "id int, score double")
    etl.run(Pipeline("p", name, name + "_t", "replace", transform=lambda df: df.withColumn(
        "score", F.when(F.col("id") == 1, F.lit(float("nan"))).otherwise(F.col("score")))))
    assert rows_of(etl.tables.read(name + "_t")) == [(1, None), (2, 2.5)]


# --- streams ----------------------------------------------------------------------

def test_stream_buckets_equal_batch_buckets(spark, tmp_path):
    df = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(minutes=7 * i), i % 3)
         for i in range(400)], "ts timestamp, k int")
    df.repartition(5).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    measures = {"n": F.count(F.lit(1))}
    found = []
    query = jobs.windowed(stream, "ts", "5 days", measures, "k", "60 days").writeStream.outputMode(
        "complete").foreachBatch(lambda b, i: found.append(rows_of(b))).option(
        "checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert found[-1] == rows_of(ts.time_bucket_agg(df, "ts", "5 days", measures, "k"))


def test_late_rows_reach_their_buckets(spark, tmp_path):
    """Newest batch first, an event sent twice, null groups and times, and a second run over nothing new."""
    day = dt.datetime(2024, 3, 1, tzinfo=dt.timezone.utc)
    given = [(i, day + dt.timedelta(minutes=97 * i), (None, "a", "b")[i % 3], float(i)) for i in range(60)]
    given.append((99, None, "a", 1.0))
    schema = "id int, ts timestamp, k string, v double"
    for part in (given[40:], given[20:45], given[:20]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    whole = spark.createDataFrame([g for g in given if g[1]], schema)
    measures = {"n": F.count(F.lit(1)), "top": F.max("v")}
    want = ts.time_bucket_agg(whole, "ts", "5 hours", measures, "k")
    kept, table = (ChunkedTable(spark, f"{stem}_{uuid.uuid4().hex[:8]}", time, "1 day")
                   for stem, time in (("arrived", "ts"), ("late", "bucket")))
    kept.create(whole.limit(0), str(tmp_path / "kept"))
    table.create(want.limit(0), str(tmp_path / "buckets"))
    for _ in range(2):
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        jobs.maintain_recomputed(stream, kept, "id", table, "5 hours", measures, str(tmp_path / "cp"), "k").awaitTermination()
        assert kept.read().count() == 60
        assert sorted(map(repr, table.read().select(*want.columns).collect())) == sorted(map(repr, want.collect()))


def test_rerun_of_a_stream_adds_nothing(spark, tmp_path):
    path = str(tmp_path / "feed")
    for part in range(3):
        feeds.notify(spark.createDataFrame([("a", str(part)), ("b", "x")],
                                           "channel string, payload string"), path)
    for _ in range(2):
        heard = feeds.listen(spark, path, ["a"], max_files=1)
        feeds.deliver_to(heard, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r.payload for r in out.collect()) == ["0", "1", "2"]
