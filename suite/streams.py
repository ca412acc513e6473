"""Streaming queries, run to the end of the present input."""

from __future__ import annotations

from pyspark.sql import functions as F

from suite.fixtures import SQL_EXACT_SUM, exact_sum, fresh_name, read, workspace
from suite.registry import query
from tidemark.operators import rows
from tidemark.operators.timeseries import time_bucket_agg
from tidemark.sources.chunks import ChunkedTable
from tidemark.streaming import feeds, jobs

VALUE = SQL_EXACT_SUM.format("value")


def _as_files(spark, sf_dir, root: str):
    """The events as a folder of files, and a stream over it: three batches, however many files there are."""
    events = jobs.as_event_time(read(spark, sf_dir, "events"), "ts")
    path = f"{root}/events"
    for third in range(3):
        events.filter(F.pmod(F.hash("event_id"), F.lit(3)) == third).write.mode(
            "append").parquet(path)
    files = len(spark.read.schema(events.schema).parquet(path).inputFiles())
    return events, spark.readStream.schema(events.schema).option(
        "maxFilesPerTrigger", max(1, -(-files // 3))).parquet(path)


@query("""
SELECT event_type AS channel, CAST(json_extract(props, '$.k') AS BIGINT) AS k, count(*) AS n
FROM events WHERE event_type IN ('click', 'error') GROUP BY 1, 2""")
def event_feed(spark, sf_dir):
    """Two channels of a feed, payloads parsed."""
    root = workspace(spark, "feed").root
    events = read(spark, sf_dir, "events")
    feeds.notify(events.select(F.col("event_type").alias("channel"),
                               F.col("props").alias("payload")), f"{root}/feed")
    heard = feeds.listen(spark, f"{root}/feed", ["click", "error"], "k bigint")
    feeds.deliver_to(heard, f"{root}/heard", f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/heard").groupBy(
        "channel", F.col("payload.k").alias("k")).agg(F.count(F.lit(1)).alias("n"))


@query(f"""
SELECT time_bucket(INTERVAL '3 hours', ts) AS bucket, event_type, count(*) AS n, {VALUE} AS total
FROM events GROUP BY 1, 2""")
def stream_cagg(spark, sf_dir):
    """Three-hour buckets kept up to date from a stream in several batches."""
    tables = workspace(spark, "stream")
    measures = {"n": F.count(F.lit(1)), "total": exact_sum("value")}
    events, stream = _as_files(spark, sf_dir, tables.root)
    table = ChunkedTable(spark, fresh_name("buckets"), "bucket", "7 days")
    table.create(rows.truncate(time_bucket_agg(events, "ts", "3 hours", measures, "event_type")),
                 f"{tables.root}/buckets")
    jobs.maintain_aggregate(stream, table, "ts", "3 hours", measures,
                            f"{tables.root}/checkpoint", "event_type", "40 days"
                            ).awaitTermination()
    return table.read().withColumn("bucket", F.col("bucket").cast("timestamp_ntz"))


@query(f"""
SELECT time_bucket(INTERVAL '3 hours', ts) AS bucket, event_type, count(*) AS n, {VALUE} AS total
FROM events GROUP BY 1, 2""")
def stream_late(spark, sf_dir):
    """Three-hour buckets from a stream whose files come newest first, so most rows are weeks late."""
    tables = workspace(spark, "late")
    measures = {"n": F.count(F.lit(1)), "total": exact_sum("value")}
    events = jobs.as_event_time(read(spark, sf_dir, "events"), "ts").select("event_id", "ts", "event_type", "value")
    path = f"{tables.root}/events"
    for third in (2, 1, 0):
        events.filter(F.least(F.floor((F.dayofmonth("ts") - 1) / 10), F.lit(2)) == third).coalesce(1).write.mode(
            "append").parquet(path)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(path)
    kept = ChunkedTable(spark, fresh_name("arrived"), "ts", "1 day")
    kept.create(rows.truncate(events), f"{tables.root}/arrived")
    table = ChunkedTable(spark, fresh_name("buckets"), "bucket", "7 days")
    table.create(rows.truncate(time_bucket_agg(events, "ts", "3 hours", measures, "event_type")),
                 f"{tables.root}/buckets")
    jobs.maintain_recomputed(stream, kept, "event_id", table, "3 hours", measures,
                             f"{tables.root}/checkpoint", "event_type").awaitTermination()
    return table.read().withColumn("bucket", F.col("bucket").cast("timestamp_ntz"))


@query("""
SELECT user_id, ts, event_id, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def stream_upsert(spark, sf_dir):
    """The newest event of each user, kept from a stream that arrives in any order."""
    tables, target = workspace(spark, "upserts"), fresh_name("latest")
    events, stream = _as_files(spark, sf_dir, tables.root)
    columns = ["user_id", "ts", "event_id", "event_type", "value"]
    tables.write(rows.truncate(events.select(*columns)), target)
    jobs.maintain_rows(stream.select(*columns), tables, target, "user_id", ["ts", "event_id"],
                       f"{tables.root}/checkpoint").awaitTermination()
    return tables.read(target).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("SELECT event_id, user_id, value FROM events")
def stream_batches(spark, sf_dir):
    """A result handed over batch by batch."""
    root = workspace(spark, "batches").root
    _, stream = _as_files(spark, sf_dir, root)
    feeds.deliver_to(stream.select("event_id", "user_id", "value"), f"{root}/out",
                     f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/out").select("event_id", "user_id", "value")
