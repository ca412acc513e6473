from __future__ import annotations

import datetime as dt
from urllib.parse import unquote

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from tidemark.session import scratch_dir
from tidemark.sources import chunks, csvfiles, snapshots
from tidemark.sources.chunks import ChunkedTable
from tidemark.sources.tables import KeyViolation


def _frame(spark, data):
    return spark.createDataFrame(data, "id int, val string")


def test_write_modes(spark, tables, name):
    assert tables.write(_frame(spark, [(1, "a"), (2, "b")]), name) == 2
    with pytest.raises(ValueError, match="already exists"):
        tables.write(_frame(spark, [(3, "c")]), name)
    assert tables.write(_frame(spark, [(3, "c")]), name, "append") == 1
    assert tables.write(_frame(spark, [(9, "z")]), name, "replace", {"id": "bigint"}) == 1
    assert rows_of(tables.read(name)) == [(9, "z")]
    assert dict(tables.read(name).dtypes)["id"] == "bigint"
    with pytest.raises(ValueError):
        tables.write(_frame(spark, []), name, "merge")
    with pytest.raises(ValueError, match="does not exist"):
        tables.read(name + "_absent")


def test_key_is_checked_before_publishing(spark, tables, name):
    tables.write(_frame(spark, [(1, "keep")]), name)
    with pytest.raises(KeyViolation):
        tables.write(_frame(spark, [(1, "a"), (1, "b")]), name, "replace", primary_key="id")
    assert rows_of(tables.read(name)) == [(1, "keep")]


def test_append_aligns_and_counts(spark, tables, name):
    tables.write(_frame(spark, [(1, "a")]), name)
    assert tables.append(spark.createDataFrame([(2,)], "id long"), name) == 1
    assert tables.append(_frame(spark, []), name) == 0
    assert rows_of(tables.read(name)) == [(1, "a"), (2, None)]


def test_changes_report_their_rows(spark, tables, name):
    tables.write(_frame(spark, [(1, "old"), (2, "keep"), (None, "n")]), name)
    assert tables.upsert(_frame(spark, [(1, "new"), (3, "add")]), name, "id") == 2
    assert tables.update(name, {"val": "u"}, {"id": 2}) == 1
    assert tables.delete(name, "id = 3") == 1
    assert tables.delete(name, "id = 77") == 0
    assert tables.insert_ignore(_frame(spark, [(1, "x"), (4, "y")]), name, "id") == 1
    assert rows_of(tables.read(name)) == [(1, "new"), (2, "u"), (4, "y"), (None, "n")]
    tables.truncate(name)
    assert tables.read(name).count() == 0


def test_old_versions_can_be_removed(spark, tables, name):
    tables.write(_frame(spark, [(1, "a")]), name)
    tables.update(name, {"val": "b"}, {"id": 1})
    tables.update(name, {"val": "c"}, {"id": 1})
    assert tables.remove_old_versions(name) == 2
    assert tables.remove_old_versions(name) == 0
    assert rows_of(tables.read(name)) == [(1, "c")]


def test_failed_upsert_leaves_the_table(spark, tables, name):
    tables.write(_frame(spark, [(1, "old")]), name)
    with pytest.raises(Exception, match="touch a row twice"):
        tables.upsert(_frame(spark, [(1, "a"), (1, "b")]), name, "id")
    assert rows_of(tables.read(name)) == [(1, "old")]


def test_csv_keeps_nulls_quotes_and_line_breaks(spark, tables, name, tmp_path):
    data = [(1, 'a "quoted", line\nbreak'), (2, None), (3, ""), (4, " padded ")]
    df = _frame(spark, data)
    path = str(tmp_path / "csv")
    assert csvfiles.export_csv(df, path, null_string="NULL") == 4
    tables.write(df.limit(0), name)
    assert csvfiles.import_csv(tables, path, name, null_string="NULL", multi_line=True) == 4
    assert rows_of(tables.read(name)) == sorted(data, key=lambda r: (False, str(r[0])))
    csvfiles.export_csv(df, path + "_plain")
    tables.truncate(name)
    csvfiles.import_csv(tables, path + "_plain", name, multi_line=True)
    assert rows_of(tables.read(name)) == sorted(data, key=lambda r: (False, str(r[0])))
    with pytest.raises(ValueError):
        csvfiles.import_csv(tables, path, name, columns=["nope"])
    with pytest.raises(ValueError):
        csvfiles.export_csv(df, path + "2", delimiter="||")


def test_snapshot_options(spark, tables, name, tmp_path):
    tables.write(_frame(spark, [(1, "a")]), name)
    path = str(tmp_path / "snap")
    assert snapshots.save(tables, [name], path) == [name]
    with pytest.raises(ValueError, match="already exists"):
        snapshots.load(tables, path)
    snapshots.load(tables, path, prefix="s_", schema_only=True)
    assert tables.read("s_" + name).count() == 0
    snapshots.load(tables, path, prefix="s_", data_only=True)
    snapshots.load(tables, path, prefix="s_", data_only=True)
    assert tables.read("s_" + name).count() == 2
    snapshots.load(tables, path, prefix="s_", clean=True)
    assert rows_of(tables.read("s_" + name)) == [(1, "a")]
    with pytest.raises(ValueError):
        snapshots.save(tables, [name], path + "2", schema_only=True, data_only=True)


# --- chunks -----------------------------------------------------------------------

T0 = dt.datetime(2024, 1, 1)


@pytest.fixture
def chunked(spark, name, tmp_path):
    """One row per day, the value is the day's number."""
    df = spark.createDataFrame([(T0 + dt.timedelta(days=d), float(d)) for d in range(10)],
                               "ts timestamp, val double")
    table = ChunkedTable(spark, name, "ts")
    return table.create(df, str(tmp_path / "chunks"), migrate_data=True)


def test_chunk_listing_and_dropping(chunked):
    assert chunked.show_chunks().count() == 10
    old = chunked.show_chunks("3 days", now=T0 + dt.timedelta(days=10))
    assert [r.first_time.day for r in old.collect()] == [1, 2, 3, 4, 5, 6, 7]
    planned = chunked.drop_chunks(older_than=T0 + dt.timedelta(days=4), dry_run=True)
    assert len(planned) == 4 and chunked.show_chunks().count() == 10
    assert chunked.drop_chunks(older_than=T0 + dt.timedelta(days=4)) == planned
    assert [r.val for r in chunked.read().orderBy("ts").collect()] == [4, 5, 6, 7, 8, 9]
    assert chunked.retain("2 days", now=T0 + dt.timedelta(days=10), dry_run=True) != []
    with pytest.raises(ValueError):
        chunked.drop_chunks()
    with pytest.raises(TypeError):
        chunked.show_chunks(older_than=5)


def test_dropped_rows_do_not_come_back(spark, chunked):
    chunked.drop_chunks(older_than=T0 + dt.timedelta(days=2))
    late = spark.createDataFrame([(T0 + dt.timedelta(hours=1), 77.0)], "ts timestamp, val double")
    chunked.append(late)
    assert [r.val for r in chunked.read().orderBy("ts").collect()] == [77, 2, 3, 4, 5, 6, 7, 8, 9]


def test_range_read_opens_only_its_chunks(chunked):
    part = chunked.read(T0 + dt.timedelta(days=3, hours=1), T0 + dt.timedelta(days=5))
    assert [r.val for r in part.collect()] == [4.0]
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(chunk_start" in plan


def test_chunked_create_options(spark, chunked, tmp_path):
    df = chunked.read()
    with pytest.raises(ValueError, match="already exists"):
        chunked.create(df, str(tmp_path / "again"))
    assert chunked.create(df, str(tmp_path / "again"), if_not_exists=True) is chunked
    with pytest.raises(Exception, match="must not be NULL"):
        chunked.append(df.withColumn("ts", F.lit(None).cast("timestamp")))
    for bad in (0, True, "4"):
        with pytest.raises(ValueError):
            chunks.hash_dimension(df, "val", bad)
    for bad in ({}, {"number_partitions": 2, "chunk_interval": 5}, {"chunk_interval": 0}):
        with pytest.raises(ValueError):
            chunks.dimension(df, "val", **bad)


def test_chunk_dimension_and_drop(spark, name, tmp_path):
    df = spark.createDataFrame([(T0 + dt.timedelta(days=d % 3), d) for d in range(30)],
                               "ts timestamp_ntz, k int")
    table = ChunkedTable(spark, name, "ts", "1 day", ("k", {"number_partitions": 4}))
    table.create(df, str(tmp_path / "dim"), migrate_data=True)
    assert spark.table(name).select("dim_bucket").distinct().count() == 4
    table.drop_chunks(older_than=T0 + dt.timedelta(days=1))
    assert table.read().count() == 20


def test_chunked_upsert_touches_its_chunks_only(spark, name, tmp_path):
    df = spark.createDataFrame([(T0 + dt.timedelta(days=d), d, "old") for d in range(6)],
                               "ts timestamp, k int, v string")
    table = ChunkedTable(spark, name, "ts")
    table.create(df, str(tmp_path / "up"), migrate_data=True)
    before = {r.f for r in spark.table(name).select(F.input_file_name().alias("f")).collect()}
    batch = spark.createDataFrame(
        [(T0 + dt.timedelta(days=2), 2, "new"), (T0 + dt.timedelta(days=2, hours=1), 9, "add")],
        df.schema)
    assert table.upsert(batch, ["ts", "k"]) == 2
    after = {r.f for r in spark.table(name).select(F.input_file_name().alias("f")).collect()}
    assert len(before & after) == 5
    assert sorted(r.v for r in table.read().collect()) == ["add"] + ["new"] + ["old"] * 5
    with pytest.raises(ValueError):
        table.upsert(batch, ["k"])


def test_chunked_upsert_with_null_and_changed_dimension(spark, name, tmp_path):
    schema = "ts timestamp, k int, part int, v string"
    old = [(T0, i, None if i % 2 else i, "old") for i in range(6)] + [(T0 + dt.timedelta(days=1), 9, None, "old")]
    table = ChunkedTable(spark, name, "ts", "1 day", ("part", {"chunk_interval": 2}))
    table.create(spark.createDataFrame(old, schema), str(tmp_path / "dim"), migrate_data=True)
    batch = [(T0, 1, None, "new"), (T0, 2, 5, "moved"), (T0, 4, None, "moved"), (T0, 7, None, "add")]
    assert table.upsert(spark.createDataFrame(batch, schema), ["ts", "k"]) == 4
    got = {r.k: (r.part, r.v) for r in table.read().collect()}
    assert got == {0: (0, "old"), 1: (None, "new"), 2: (5, "moved"), 3: (None, "old"), 4: (None, "moved"),
                   5: (None, "old"), 7: (None, "add"), 9: (None, "old")}
    assert table.read().count() == 8
    assert table.upsert(spark.createDataFrame([], schema), ["ts", "k"]) == 0
    table.append(spark.createDataFrame([(T0, 20, None, "more")], schema))
    assert table.read().count() == 9
    table.drop_chunks(older_than=T0 + dt.timedelta(days=1))
    assert [r.k for r in table.read().collect()] == [9]
    table.append(spark.createDataFrame([(T0, 20, None, "more")], schema))
    assert sorted(r.k for r in table.read().collect()) == [9, 20]


def test_failed_rewrite_leaves_the_chunks(spark, name, tmp_path):
    schema = "ts timestamp, k int, v string"
    table = ChunkedTable(spark, name, "ts")
    table.create(spark.createDataFrame([(T0, 1, "old")], schema), str(tmp_path / "f"), migrate_data=True)
    broken = spark.createDataFrame([(T0, 1, "x")], schema).withColumn(
        "v", F.raise_error(F.lit("boom")).cast("string"))
    with pytest.raises(Exception, match="boom"):
        table.upsert(broken, ["ts", "k"])
    assert [tuple(r) for r in table.read().collect()] == [(T0, 1, "old")]


def test_upsert_scans_touched_chunks_whatever_may_be_broadcast(spark, name, tmp_path):
    schema = "ts timestamp, k int, v string"
    df = spark.createDataFrame([(T0 + dt.timedelta(days=d), d, "old") for d in range(8)], schema)
    table = ChunkedTable(spark, name, "ts")
    table.create(df, str(tmp_path / "scan"), migrate_data=True)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    written = []
    original = ChunkedTable.replace

    def watched(self, rows, paths, **options):
        written.extend(paths)
        plan = rows._jdf.queryExecution().executedPlan().toString()
        bounds = plan.split("PartitionFilters: [")[1].split("]")[0]
        assert "chunk_start" in bounds and "2024-01-01 00:00:00" in bounds and "dynamic" not in bounds
        return original(self, rows, paths, **options)

    ChunkedTable.replace = watched
    try:
        table.upsert(spark.createDataFrame([(T0, 0, "new")], schema), ["ts", "k"])
    finally:
        ChunkedTable.replace = original
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(written) == 1
    assert table.read().filter("v = 'new'").count() == 1 and table.read().count() == 8
    assert len(table.chunks()) == 8


def test_compaction_remembers_and_notices_changes(spark, name, tmp_path):
    schema = "ts timestamp, k int, v string"
    df = spark.createDataFrame([(T0 + dt.timedelta(days=d), d, "old") for d in range(5)], schema)
    table = ChunkedTable(spark, name, "ts")
    table.create(df, str(tmp_path / "c"), migrate_data=True)
    assert len(table.compact("k")) == 5 and table.compact("k") == []
    table.append(spark.createDataFrame([(T0 + dt.timedelta(days=3), 8, "add")], schema))
    assert table.compact("k") == [T0 + dt.timedelta(days=3)]
    table.upsert(spark.createDataFrame([(T0, 0, "new")], schema), ["ts", "k"])
    assert table.compact("k") == [T0] and table.compact("k") == []
    assert table.read().count() == 6


def test_compaction_sorts_old_chunks(spark, name, tmp_path):
    df = spark.createDataFrame(
        [(T0 + dt.timedelta(hours=h), h % 3) for h in range(96)], "ts timestamp, k int")
    table = ChunkedTable(spark, name, "ts")
    path = str(tmp_path / "compact")
    table.create(df.repartition(8), path, migrate_data=True)
    spark.conf.set("spark.sql.parquet.compression.codec", "snappy")
    done = table.compact("k", "ts DESC", "2 days", T0 + dt.timedelta(days=4))
    spark.conf.set("spark.sql.parquet.compression.codec", "zstd")
    assert len(done) == 2 and table.read().count() == 96
    files = [r.f for r in spark.table(name).filter(F.col("ts") < T0 + dt.timedelta(days=1))
             .select(F.input_file_name().alias("f")).distinct().collect()]
    assert files[0].endswith(".zstd.parquet")
    stored = spark.read.parquet(unquote(files[0])).collect()
    assert stored == sorted(stored, key=lambda r: (r.k, -r.ts.timestamp()))


def test_scratch_is_under_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    one, two = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert one != two
    if shared:
        assert one.startswith(f"{shared.rstrip('/')}/x-")
