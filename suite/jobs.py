"""Chunked tables, continuous aggregates and load pipelines."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from suite.fixtures import SQL_EXACT_SUM, exact_sum, fresh_name, read, workspace
from suite.registry import query
from tidemark.operators import filters, rows
from tidemark.plans.cagg import ContinuousAggregate, Materialization
from tidemark.plans.etl import Etl, Pipeline, pandas_step
from tidemark.sources import chunks
from tidemark.sources.chunks import ChunkedTable

NOW = dt.datetime(2024, 1, 31)
VALUE = SQL_EXACT_SUM.format("value")


# --- chunked tables ---------------------------------------------------------------

def _chunked(spark, sf_dir, width="1 day", **options) -> ChunkedTable:
    tables = workspace(spark, "chunked")
    table = ChunkedTable(spark, fresh_name("events"), "ts", width, **options)
    return table.create(read(spark, sf_dir, "events"), f"{tables.root}/events",
                        migrate_data=True)


@query("""
SELECT event_id, ts, value, time_bucket(INTERVAL '1 day', ts) AS chunk_start FROM events
WHERE ts >= TIMESTAMP '2024-01-09 12:00:00' AND ts < TIMESTAMP '2024-01-23 06:00:00'""")
def chunked_write(spark, sf_dir):
    """Write daily chunks and read a range, which opens only the chunks it touches."""
    table = _chunked(spark, sf_dir)
    part = table.read(dt.datetime(2024, 1, 9, 12), dt.datetime(2024, 1, 23, 6))
    return chunks.with_chunk(part.select("event_id", "ts", "value"), "ts")


SQL_CHUNKS = """
SELECT time_bucket(INTERVAL '1 week', ts) AS range_start,
       time_bucket(INTERVAL '1 week', ts) + INTERVAL '7 days' AS range_end,
       count(*) AS n_rows, min(ts) AS first_time, max(ts) AS last_time
FROM events GROUP BY 1, 2"""


@query(f"""
SELECT * FROM ({SQL_CHUNKS}) q WHERE range_end <= TIMESTAMP '2024-01-24'
AND range_start >= TIMESTAMP '2024-01-01'""")
def show_chunks(spark, sf_dir):
    """Weekly chunks at least a week old but not older than January."""
    table = _chunked(spark, sf_dir, "1 week")
    return table.show_chunks("7 days", dt.datetime(2024, 1, 1), NOW)


@query(SQL_CHUNKS)
def chunk_stats(spark, sf_dir):
    return _chunked(spark, sf_dir, "1 week").show_chunks()


@query("""
SELECT event_id, ts, event_type FROM events
WHERE NOT (time_bucket(INTERVAL '1 day', ts) + INTERVAL '1 day' <= TIMESTAMP '2024-01-20'
           AND time_bucket(INTERVAL '1 day', ts) >= TIMESTAMP '2024-01-05')""")
def drop_chunks(spark, sf_dir):
    """Drop the chunks between two bounds; a dry run first changes nothing."""
    table = _chunked(spark, sf_dir)
    bounds = {"older_than": dt.datetime(2024, 1, 20), "newer_than": dt.datetime(2024, 1, 5)}
    planned = table.drop_chunks(**bounds, dry_run=True)
    dropped = table.drop_chunks(**bounds)
    if planned != dropped:
        raise AssertionError("a dry run lists what a real run drops")
    return table.read().select("event_id", "ts", "event_type")


@query("""
SELECT event_id, ts FROM events
WHERE time_bucket(INTERVAL '1 day', ts) + INTERVAL '1 day' > TIMESTAMP '2024-01-21'""")
def retention(spark, sf_dir):
    """Keep ten days."""
    table = _chunked(spark, sf_dir)
    table.retain("10 days", NOW)
    return table.read().select("event_id", "ts")


@query("""
SELECT chunk_start, user_id, n, 1 AS n_buckets, true AS in_range FROM (
  SELECT time_bucket(INTERVAL '1 week', ts) AS chunk_start, user_id, count(*) AS n FROM events GROUP BY 1, 2) q""")
def hash_dimension(spark, sf_dir):
    """Rows per chunk and user; a user's rows share one of four hash buckets."""
    table = _chunked(spark, sf_dir, "1 week",
                     dimension_of=("user_id", {"number_partitions": 4}))
    per_user = Window.partitionBy("user_id")
    return spark.table(table.name).groupBy("chunk_start", "user_id", "dim_bucket").agg(
        F.count(F.lit(1)).alias("n")).select(
        "chunk_start", "user_id", "n",
        F.size(F.collect_set("dim_bucket").over(per_user)).alias("n_buckets"),
        F.col("dim_bucket").between(0, 3).alias("in_range"))


@query("""
SELECT event_id, ts, CASE WHEN event_id % 5 = 0 THEN user_id + 60 WHEN event_id % 3 <> 0 THEN user_id END AS user_id,
       CASE WHEN event_id % 5 = 0 THEN 'moved' ELSE event_type END AS event_type
FROM events""")
def chunk_upsert_dimension(spark, sf_dir):
    """Rows with and without a dimension; a fifth of them move to another range of it."""
    tables = workspace(spark, "chunked")
    events = read(spark, sf_dir, "events").select(
        "event_id", "ts", F.when(F.col("event_id") % 3 != 0, F.col("user_id")).alias("user_id"), "event_type")
    table = ChunkedTable(spark, fresh_name("events"), "ts", "1 week", ("user_id", {"chunk_interval": 25}))
    table.create(events, f"{tables.root}/events", migrate_data=True)
    moved = read(spark, sf_dir, "events").filter("event_id % 5 = 0").select(
        "event_id", "ts", (F.col("user_id") + 60).alias("user_id"), F.lit("moved").alias("event_type"))
    table.upsert(moved, ["event_id", "ts"])
    return table.read()


@query("""
SELECT time_bucket(INTERVAL '1 week', ts) AS chunk_start, user_id // 25 AS dim_bucket,
       count(*) AS n FROM events GROUP BY 1, 2""")
def range_dimension(spark, sf_dir):
    """Rows per chunk and range of 25 users."""
    table = _chunked(spark, sf_dir, "1 week", dimension_of=("user_id", {"chunk_interval": 25}))
    return spark.table(table.name).groupBy("chunk_start", "dim_bucket").agg(
        F.count(F.lit(1)).alias("n"))


@query("SELECT * FROM events")
def compact_chunks(spark, sf_dir):
    """Compaction sorts the chunks older than a week and keeps every row."""
    table = _chunked(spark, sf_dir)
    table.compact("event_type", "ts DESC", "7 days", NOW)
    return table.read()


# --- continuous aggregates --------------------------------------------------------

def _cagg(spark, sf_dir, with_no_data=False, **options) -> Materialization:
    tables = workspace(spark, "cagg")
    definition = ContinuousAggregate(
        fresh_name("hourly"), lambda s: read(s, sf_dir, "events"), "ts", "1 hour",
        {"n": F.count(F.lit(1)), "total": exact_sum("value"), "high": F.max("value")},
        ("event_type",), chunk_interval="7 days", **options)
    return Materialization(spark, definition).create(f"{tables.root}/hourly", with_no_data)


SQL_HOURLY = f"""
SELECT time_bucket(INTERVAL '1 hour', ts) AS bucket, event_type, count(*) AS n, {VALUE} AS total,
       max(value) AS high FROM events GROUP BY 1, 2"""


@query(SQL_HOURLY)
def cagg_create(spark, sf_dir):
    """Created with data."""
    return _cagg(spark, sf_dir).stored()


@query(f"""
SELECT * FROM ({SQL_HOURLY}) q WHERE bucket >= TIMESTAMP '2024-01-05 01:00:00'
AND bucket < TIMESTAMP '2024-01-20 12:00:00'""")
def cagg_refresh(spark, sf_dir):
    """Only the hours fully inside the window appear."""
    job = _cagg(spark, sf_dir, with_no_data=True)
    job.refresh(dt.datetime(2024, 1, 5, 0, 30), dt.datetime(2024, 1, 20, 12, 10))
    return job.stored()


@query(f"""
SELECT * FROM ({SQL_HOURLY}) q WHERE bucket >= TIMESTAMP '2024-01-10'
AND bucket < TIMESTAMP '2024-01-29'""")
def cagg_policy(spark, sf_dir):
    """Two scheduled refreshes."""
    job = _cagg(spark, sf_dir, with_no_data=True)
    job.refresh_policy("10 days", "1 day", dt.datetime(2024, 1, 20))
    job.refresh_policy("12 days", "2 days", NOW)
    return job.stored()


@query(SQL_HOURLY)
def cagg_realtime(spark, sf_dir):
    """Buckets stored up to a date, live ones after it."""
    job = _cagg(spark, sf_dir, with_no_data=True, materialized_only=False)
    job.refresh(None, dt.datetime(2024, 1, 20))
    return job.read()


# --- load pipelines ---------------------------------------------------------------

CUT = "1998-01-01"


def _orders(spark, sf_dir, early: bool | None = None):
    orders = read(spark, sf_dir, "orders")
    if early is None:
        return orders
    cut = F.lit(CUT).cast("timestamp_ntz")
    return orders.filter(F.col("o_orderdate") < cut if early else F.col("o_orderdate") >= cut)


def _etl(spark, sf_dir, early: bool | None = None):
    """Runner, a target table name and a source view over all or half of the orders."""
    tables = workspace(spark, "etl")
    etl = Etl(tables, fresh_name("runs"))
    source = fresh_name("source")
    _orders(spark, sf_dir, early).createOrReplaceTempView(source)
    return etl, fresh_name("target"), source


@query("SELECT * FROM orders")
def etl_append(spark, sf_dir):
    """Late orders appended to a table of the early ones."""
    etl, target, source = _etl(spark, sf_dir, early=False)
    etl.tables.write(_orders(spark, sf_dir, early=True), target)
    etl.run(Pipeline("append", source, target))
    return etl.tables.read(target)


@query(f"""
SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders
WHERE o_orderdate >= TIMESTAMP '{CUT}'""")
def etl_replace(spark, sf_dir):
    """A query's result replaces the table."""
    etl, target, source = _etl(spark, sf_dir, early=False)
    text = f"SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM {source};"
    etl.tables.write(_orders(spark, sf_dir, early=True).select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"), target)
    etl.run(Pipeline("replace", text, target, "replace"))
    return etl.tables.read(target)


@query("""
SELECT o_orderkey, lower(trim(o_orderpriority)) AS o_orderpriority,
       o_totalprice * 2 AS o_totalprice FROM orders WHERE o_orderstatus <> 'F'""")
def etl_transform(spark, sf_dir):
    """A chain of DataFrame steps and one pandas step."""
    def not_final(df):
        return df.filter("o_orderstatus <> 'F'").drop("o_orderstatus")

    def double(pdf):
        return pdf.assign(o_totalprice=pdf["o_totalprice"] * 2)

    etl, target, source = _etl(spark, sf_dir)
    schema = "o_orderkey long, o_orderpriority string, o_totalprice double"
    etl.run(Pipeline(
        "transform",
        f"SELECT o_orderkey, o_orderstatus, o_orderpriority, o_totalprice FROM {source}",
        target, "replace",
        transform=(not_final, rows.trim_lower("o_orderpriority"), pandas_step(double, schema))))
    return etl.tables.read(target)


@query("SELECT * FROM orders")
def etl_incremental(spark, sf_dir):
    """Two runs: the second extracts only what is newer than the first run's mark."""
    etl, target, source = _etl(spark, sf_dir, early=True)
    etl.tables.write(rows.truncate(_orders(spark, sf_dir)), target)
    load = Pipeline("incremental", source, target, "upsert", ("o_orderkey",),
                    incremental_column="o_orderdate")
    first = etl.run(load)
    _orders(spark, sf_dir).createOrReplaceTempView(source)
    second = etl.run(load)
    if second.watermark_used != first.watermark_recorded:
        raise AssertionError("the second run starts at the first run's mark")
    return etl.tables.read(target)


@query(f"""
SELECT 'success' AS status, count(*) AS rows_extracted, count(*) AS rows_loaded FROM orders
WHERE o_orderdate < TIMESTAMP '{CUT}'
UNION ALL SELECT 'success', count(*), count(*) FROM orders
WHERE o_orderdate > (SELECT max(o_orderdate) FROM orders WHERE o_orderdate < TIMESTAMP '{CUT}')
UNION ALL SELECT 'success', 0, 0 UNION ALL SELECT 'failed', 0, 0""")
def run_history(spark, sf_dir):
    """History of four runs: two loads, one without news, one that fails."""
    etl, target, source = _etl(spark, sf_dir, early=True)
    etl.tables.write(rows.truncate(_orders(spark, sf_dir)), target)
    load = Pipeline("history", source, target, "upsert", ("o_orderkey",),
                    incremental_column="o_orderdate")
    etl.run(load)
    _orders(spark, sf_dir).createOrReplaceTempView(source)
    etl.run(load)
    etl.run(load)
    try:
        etl.run(Pipeline("history", source, target + "_absent"))
    except Exception:  # noqa: BLE001 - the failure is what is recorded
        pass
    return etl.history("history").select("status", "rows_extracted", "rows_loaded")


@query("""
SELECT 'dry_run' AS status, count(*) AS rows_extracted,
       count(*) FILTER (WHERE o_orderstatus = 'F') AS rows_transformed, 0 AS rows_loaded
FROM orders""")
def etl_dry_run(spark, sf_dir):
    etl, target, source = _etl(spark, sf_dir)
    result = etl.run(Pipeline("dry", source, target, "replace",
                              transform=lambda df: df.filter("o_orderstatus = 'F'")),
                     dry_run=True)
    if etl.tables.exists(target):
        raise AssertionError("a dry run writes nothing")
    return spark.createDataFrame(
        [(result.status, result.rows_extracted, result.rows_transformed, result.rows_loaded)],
        "status string, rows_extracted bigint, rows_transformed bigint, rows_loaded bigint")


@query("SELECT least(5000, count(*)) AS n FROM orders")
def extract_limit(spark, sf_dir):
    """The extract limit is the feature here."""
    etl, target, source = _etl(spark, sf_dir)
    etl.run(Pipeline("limited", source, target, "replace", extract_limit=5000))
    return filters.count_where(etl.tables.read(target))


@query("SELECT * FROM orders")
def etl_limited_catch_up(spark, sf_dir):
    """Limited runs until nothing is new; the source is in no order of the mark."""
    etl, target, source = _etl(spark, sf_dir)
    etl.tables.write(rows.truncate(_orders(spark, sf_dir)), target)
    limit = etl.tables.spark.table(source).count() // 3
    load = Pipeline("catch up", source, target, "upsert", ("o_orderkey",),
                    incremental_column="o_orderdate", extract_limit=limit)
    while etl.run(load).rows_loaded:
        pass
    return etl.tables.read(target)


@query("""
SELECT 'success' AS status, count(*) AS rows_extracted,
       count(*) FILTER (WHERE o_orderstatus <> 'F') AS rows_transformed,
       count(*) FILTER (WHERE o_orderstatus <> 'F') AS rows_loaded FROM orders""")
def run_counts_of_sorted_load(spark, sf_dir):
    """A step that sorts reads its input twice; the log has the true counts."""
    etl, target, source = _etl(spark, sf_dir)
    etl.run(Pipeline("sorted", source, target, "replace",
                     transform=lambda df: df.orderBy("o_totalprice").filter("o_orderstatus <> 'F'")))
    return etl.history("sorted").select("status", "rows_extracted", "rows_transformed", "rows_loaded")
