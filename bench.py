"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

Every query runs once cold and then several times warm; ``queries`` holds the warm
medians in seconds.  ``details`` adds the cold time, the input rows and rows per second.
Results are written out in full (to parquet, or to Spark's noop sink), never collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import functions as F

from suite import QUERIES, fixtures
from suite.jobs import CUT
from tidemark.plans.etl import Etl, Pipeline
from tidemark.session import build_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "5"))
# The published insertion benchmark loads this many rows of (id, val, label).
INSERT_ROWS = 100_000


def insert_rows(spark, count=INSERT_ROWS):
    """The insertion benchmark's own row shape."""
    key = F.col("id")
    return spark.range(count).select(
        key.cast("int").alias("id"), (key * 0.1).alias("val"),
        F.concat(F.lit("row_"), key).alias("label"))


def writes(spark):
    """``name -> (prepare, run, input rows)``; only ``run`` is timed."""
    tables = fixtures.workspace(spark, "bench")
    lineitem = fixtures.read(spark, SF_DIR, "lineitem")
    n_lineitem, orders = lineitem.count(), fixtures.read(spark, SF_DIR, "orders")
    n_orders = orders.count()

    def empty_like(df):
        name = fixtures.fresh_name("bench")
        tables.write(df.limit(0), name)
        return name

    def upsert_ready():
        name = fixtures.fresh_name("bench")
        tables.write(orders.filter(F.col("o_orderdate") < CUT), name)
        return name

    # one pipeline that runs again and again, with its log, into one table
    etl, source = Etl(tables, fixtures.fresh_name("runs")), fixtures.fresh_name("source")
    insert_rows(spark).createOrReplaceTempView(source)
    replacing = Pipeline("bench", source, fixtures.fresh_name("bench"), "replace")

    return {
        "insert_append": (lambda: empty_like(insert_rows(spark)),
                          lambda name: tables.append(insert_rows(spark), name), INSERT_ROWS),
        "insert_append_20x": (
            lambda: empty_like(insert_rows(spark)),
            lambda name: tables.append(insert_rows(spark, 20 * INSERT_ROWS), name),
            20 * INSERT_ROWS),
        "insert_write": (lambda: fixtures.fresh_name("bench"),
                         lambda name: tables.write(insert_rows(spark), name), INSERT_ROWS),
        "insert_etl_replace": (lambda: None, lambda _: etl.run(replacing), INSERT_ROWS),
        "bulk_append": (lambda: empty_like(lineitem),
                        lambda name: tables.append(lineitem, name), n_lineitem),
        "incremental_upsert": (upsert_ready,
                               lambda name: tables.upsert(orders, name, "o_orderkey"), n_orders),
    }


def reads(spark):
    inputs = {
        "time_bucket_hour": ["events"], "time_bucket_week": ["lineitem"],
        "gapfill_locf": ["events"], "gapfill_interpolate": ["events"],
        "last_per_key": ["events"], "moving_avg": ["events"], "upsert_merge": ["orders"],
        "spatial_within_join": ["customer", "nation"], "contains_ref": ["customer", "nation"],
        "dwithin_pairs": ["customer", "supplier"], "dwithin_ref_sphere": ["customer", "supplier"],
        "nearest_k": ["customer"], "overlap_pairs": ["supplier"],
        "geo_distance_spheroid": ["customer"], "pk_violations": ["lineitem"],
        "fk_orphans": ["lineitem", "part"], "column_profile": ["orders"],
    }

    def run(name):
        return lambda _: QUERIES[name](spark, SF_DIR).write.format("noop").mode(
            "overwrite").save()

    counts = {t: fixtures.read(spark, SF_DIR, t).count() for ts in inputs.values() for t in ts}
    return {name: (lambda: None, run(name), sum(counts[t] for t in tables))
            for name, tables in inputs.items()}


def main() -> None:
    spark = build_session("bench", **{
        "spark.master": f"local[{CPUS}]", "spark.sql.shuffle.partitions": CPUS,
        "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("OFF")
    queries, details = {}, {}
    for name, (prepare, run, rows) in {**writes(spark), **reads(spark)}.items():
        times = []
        for _ in range(RUNS + 1):
            given = prepare()
            start = time.perf_counter()
            run(given)
            times.append(time.perf_counter() - start)
        warm = statistics.median(times[1:]) if RUNS else times[0]
        queries[name] = round(warm, 4)
        details[name] = {"cold": round(times[0], 4), "rows": rows, "rows_per_s": round(rows / warm)}
        print(f"{name:24s} {warm:8.3f}s {rows / warm:12.0f} rows/s", file=sys.stderr)
    print(json.dumps({
        "metric": "total_warm_seconds", "value": round(sum(queries.values()), 4), "unit": "sec",
        "queries": queries, "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
        "cpus": CPUS, "machine_cpus": os.cpu_count(), "runs": RUNS, "details": details}))


if __name__ == "__main__":
    main()
