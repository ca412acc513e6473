"""Time-series queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from suite.fixtures import SQL_EXACT_SUM, exact_sum, read
from suite.registry import query
from tidemark.operators import timeseries as ts

VALUE = SQL_EXACT_SUM.format("value")
START, FINISH = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 31)
# every seventh value missing, to tell an empty bucket from a bucket of NULLs
HOLES = "CASE WHEN event_id % 7 <> 0 THEN value END"
SQL_HOLES = SQL_EXACT_SUM.format(HOLES)


def _bucketed(table: str, time: str, width: str, by: str, amount: str) -> str:
    total = SQL_EXACT_SUM.format(amount)
    return (f"SELECT time_bucket(INTERVAL '{width}', {time}) AS bucket, {by}, count(*) AS n, "
            f"{total} AS total, min({amount}) AS low, max({amount}) AS high "
            f"FROM {table} GROUP BY 1, 2")


def _measures(amount: str) -> dict:
    return {"n": F.count(F.lit(1)), "total": exact_sum(amount), "low": F.min(amount),
            "high": F.max(amount)}


@query(_bucketed("events", "ts", "1 hour", "event_type", "value"))
def time_bucket_hour(spark, sf_dir):
    """Hourly buckets of the events per type."""
    return ts.time_bucket_agg(
        read(spark, sf_dir, "events"), "ts", "1 hour", _measures("value"), "event_type")


@query(_bucketed("orders", "o_orderdate", "5 days", "o_orderstatus", "o_totalprice"))
def time_bucket_5day(spark, sf_dir):
    return ts.time_bucket_agg(read(spark, sf_dir, "orders"), "o_orderdate", "5 days",
                              _measures("o_totalprice"), "o_orderstatus")


@query(_bucketed("lineitem", "l_shipdate", "1 week", "l_returnflag", "l_extendedprice"))
def time_bucket_week(spark, sf_dir):
    """Weeks start on Monday."""
    return ts.time_bucket_agg(read(spark, sf_dir, "lineitem"), "l_shipdate", "1 week",
                              _measures("l_extendedprice"), "l_returnflag")


@query(_bucketed("lineitem", "l_shipdate", "1 month", "l_linestatus", "l_extendedprice"))
def time_bucket_month(spark, sf_dir):
    return ts.time_bucket_agg(read(spark, sf_dir, "lineitem"), "l_shipdate", "1 month",
                              _measures("l_extendedprice"), "l_linestatus")


@query(f"""
SELECT time_bucket(INTERVAL '1 day', ts) AS bucket, user_id, event_type,
       {VALUE} / count(*) AS avg_value, max(value) AS max_value, min(value) AS min_value,
       count(*) AS samples
FROM events GROUP BY 1, 2, 3""")
def bucket_by_key(spark, sf_dir):
    return ts.time_bucket_agg(
        read(spark, sf_dir, "events"), "ts", "1 day",
        {"avg_value": exact_sum("value") / F.count(F.lit(1)), "max_value": F.max("value"),
         "min_value": "min(value)", "samples": "count(*)"},
        ["user_id", "event_type"])


SPINE = f"""
WITH b AS (
  SELECT user_id, time_bucket(INTERVAL '6 hours', ts) AS bucket, {SQL_HOLES} AS total,
         count(*) AS n
  FROM events
  WHERE ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-01-31' GROUP BY 1, 2),
spine AS (
  SELECT u.user_id, g.bucket FROM (SELECT DISTINCT user_id FROM events) u
  CROSS JOIN (SELECT unnest(generate_series(TIMESTAMP '2024-01-01',
      TIMESTAMP '2024-01-30 18:00:00', INTERVAL '6 hours')) AS bucket) g),
j AS (SELECT s.user_id, s.bucket, b.total, b.n, b.bucket IS NOT NULL AS present,
             epoch(s.bucket)::BIGINT // 21600 AS pos
      FROM spine s LEFT JOIN b ON s.user_id = b.user_id AND s.bucket = b.bucket)"""


def _filled(spark, sf_dir, **options):
    return ts.gapfill(read(spark, sf_dir, "events"), "ts", "6 hours", START, FINISH,
                      {"total": exact_sum(F.expr(HOLES)), "n": F.count(F.lit(1))}, "user_id", **options)


@query(SPINE + " SELECT user_id, bucket, total, n FROM j")
def gapfill_null(spark, sf_dir):
    """Every 6-hour bucket of January for every user."""
    return _filled(spark, sf_dir)


@query(SPINE + """
SELECT user_id, bucket, last_value(CASE WHEN present THEN {'v': total} END IGNORE NULLS)
         OVER (PARTITION BY user_id ORDER BY bucket).v AS total, n FROM j""")
def gapfill_locf(spark, sf_dir):
    """A gap takes the last bucket's value, even when that is NULL."""
    return _filled(spark, sf_dir, locf=["total"])


@query(SPINE + """
SELECT user_id, bucket, last_value(total IGNORE NULLS)
         OVER (PARTITION BY user_id ORDER BY bucket) AS total, n FROM j""")
def gapfill_locf_missing(spark, sf_dir):
    """A gap or a NULL takes the last value that is not NULL."""
    return _filled(spark, sf_dir, locf=["total"], treat_null_as_missing=True)


@query(SPINE + """,
k AS (SELECT *, last_value(CASE WHEN present THEN {'p': pos, 'v': total} END IGNORE NULLS)
          OVER (PARTITION BY user_id ORDER BY bucket) AS a,
        first_value(CASE WHEN present THEN {'p': pos, 'v': total} END IGNORE NULLS)
          OVER (PARTITION BY user_id ORDER BY bucket
                ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS z FROM j)
SELECT user_id, bucket, n, CASE WHEN present THEN total
  ELSE (a.v * (z.p - pos) + z.v * (pos - a.p)) / (z.p - a.p) END AS total FROM k""")
def gapfill_interpolate(spark, sf_dir):
    """A gap lies on the line between its neighbours; outside of them it is NULL."""
    return _filled(spark, sf_dir, interpolate=["total"])


@query("""
SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-15'""")
def time_range(spark, sf_dir):
    return ts.time_range(read(spark, sf_dir, "events"), "ts", dt.datetime(2024, 1, 8),
                         dt.datetime(2024, 1, 15))


@query("""
SELECT user_id, ts, event_id, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS FIRST,
                           event_id DESC) = 1""")
def last_per_key(spark, sf_dir):
    """Newest event of each user."""
    return ts.last_per_key(read(spark, sf_dir, "events"), "user_id", "ts", "event_id",
                           ["ts", "event_id", "event_type", "value"])


@query("""
SELECT event_id, event_type, ts, n,
       CAST(s AS DOUBLE) / n AS moving_avg FROM (
  SELECT event_id, event_type, ts,
         count(*) OVER w AS n, sum(CAST(value AS DECIMAL(18,2))) OVER w AS s
  FROM events
  WINDOW w AS (PARTITION BY event_type ORDER BY ts
               RANGE BETWEEN INTERVAL '2 hours' PRECEDING AND CURRENT ROW)) q""")
def moving_avg(spark, sf_dir):
    """Average of the last two hours per event type, at each event."""
    events = read(spark, sf_dir, "events").select("event_id", "event_type", "ts", "value")
    rolled = ts.moving_measures(
        events, "ts", "2 hours",
        {"n": ("count", F.lit(1)), "total": ("sum", F.col("value").cast("decimal(18,2)"))},
        "event_type")
    return rolled.select("event_id", "event_type", "ts", "n",
                         (F.col("total").cast("double") / F.col("n")).alias("moving_avg"))
