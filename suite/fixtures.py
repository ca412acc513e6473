"""Inputs that Spark derives from the given tables, and their SQL twins.

The tables hold no geometry, so positions are computed from keys with the same double
arithmetic on both sides.  SRID 4326: x is the longitude, y the latitude.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.geometry import st_line, st_point, st_polygon, st_rectangle
from tidemark.session import scratch_dir
from tidemark.sources.tables import Tables


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def workspace(spark: SparkSession, purpose: str) -> Tables:
    """Tables in a fresh shared folder."""
    return Tables(spark, scratch_dir(spark, purpose))


def fresh_name(stem: str) -> str:
    return f"{stem}_{uuid.uuid4().hex[:12]}"


def exact_sum(column: str | Column) -> Column:
    """Sum of amounts in cents, free of rounding whatever the order of addition."""
    value = F.col(column) if isinstance(column, str) else column
    return F.sum(value.cast("decimal(18,2)")).cast("double")


SQL_EXACT_SUM = "CAST(sum(CAST({0} AS DECIMAL(18,2))) AS DOUBLE)"


# --- positions --------------------------------------------------------------------

def site_xy(key: Column) -> tuple[Column, Column]:
    return ((key * 37) % 3600).cast("double") / 10 - 180, (
        (key * 53) % 1700).cast("double") / 10 - 85


def depot_xy(key: Column) -> tuple[Column, Column]:
    return ((key * 197) % 3600).cast("double") / 10 - 180, (
        (key * 311) % 1700).cast("double") / 10 - 85


def zone_corner(key: Column) -> tuple[Column, Column]:
    return F.lit(-180.0) + (key % 5) * 72.0, F.lit(-85.0) + F.floor(key / 5) * 34.0


def sites(spark, sf_dir) -> DataFrame:
    """Customers as points."""
    x, y = site_xy(F.col("c_custkey"))
    return read(spark, sf_dir, "customer").withColumn("geometry", st_point(x, y))


def depots(spark, sf_dir) -> DataFrame:
    """Suppliers as points."""
    x, y = depot_xy(F.col("s_suppkey"))
    return read(spark, sf_dir, "supplier").withColumn("geometry", st_point(x, y))


def zones(spark, sf_dir) -> DataFrame:
    """Nations as rectangles of 72 by 34 degrees."""
    x, y = zone_corner(F.col("n_nationkey"))
    return read(spark, sf_dir, "nation").withColumn(
        "geometry", st_rectangle(x, y, x + 72.0, y + 34.0))


def triangles(spark, sf_dir) -> DataFrame:
    """Nations as the lower left half of their rectangle."""
    x, y = zone_corner(F.col("n_nationkey"))
    return read(spark, sf_dir, "nation").withColumn(
        "geometry", st_polygon([(x, y), (x + 72.0, y), (x, y + 34.0), (x, y)]))


def plots(spark, sf_dir) -> DataFrame:
    """Customers as boxes, lower left corner at the site."""
    key = F.col("c_custkey")
    x, y = site_xy(key)
    return read(spark, sf_dir, "customer").withColumn("geometry", st_rectangle(
        x, y, x + (key % 7 + 20).cast("double"), y + (key % 5 + 12).cast("double")))


def wedges(spark, sf_dir) -> DataFrame:
    """Customers as right triangles at the site."""
    key = F.col("c_custkey")
    x, y = site_xy(key)
    w, h = (key % 7 + 1).cast("double"), (key % 5 + 1).cast("double")
    return read(spark, sf_dir, "customer").withColumn(
        "geometry", st_polygon([(x, y), (x + w, y), (x, y + h), (x, y)]))


def corners(spark, sf_dir) -> DataFrame:
    """Customers as L-shapes at the site: arms of ``arm`` behind a square of ``thick``."""
    key = F.col("c_custkey")
    x, y = site_xy(key)
    arm, thick = (key % 7 + 2).cast("double"), (key % 3 + 1).cast("double")
    outer = arm + thick
    return read(spark, sf_dir, "customer").withColumn("geometry", st_polygon([
        (x, y), (x + outer, y), (x + outer, y + thick), (x + thick, y + thick), (x + thick, y + outer), (x, y + outer), (x, y)]))


def yards(spark, sf_dir) -> DataFrame:
    """Suppliers as boxes, lower left corner at the depot."""
    key = F.col("s_suppkey")
    x, y = depot_xy(key)
    return read(spark, sf_dir, "supplier").withColumn("geometry", st_rectangle(
        x, y, x + (key % 7 + 20).cast("double"), y + (key % 5 + 12).cast("double")))


def paths(spark, sf_dir) -> DataFrame:
    """Orders as lines between two neighbouring sites."""
    key = F.col("o_orderkey")
    return read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").withColumn(
        "geometry", st_line([site_xy(key), site_xy(key + 1)]))


def _sql_xy(key: str, a: int, b: int) -> str:
    return (f"CAST(({key} * {a}) % 3600 AS DOUBLE) / 10 - 180 AS x, "
            f"CAST(({key} * {b}) % 1700 AS DOUBLE) / 10 - 85 AS y")


SQL_SITES = f"sites AS (SELECT *, {_sql_xy('c_custkey', 37, 53)} FROM customer)"
SQL_DEPOTS = f"depots AS (SELECT *, {_sql_xy('s_suppkey', 197, 311)} FROM supplier)"
SQL_ZONES = ("zones AS (SELECT *, -180.0::DOUBLE + (n_nationkey % 5) * 72.0::DOUBLE AS x0, "
             "-85.0::DOUBLE + (n_nationkey // 5) * 34.0::DOUBLE AS y0 FROM nation)")
SQL_PLOTS = ("plots AS (SELECT *, x + CAST(c_custkey % 7 + 20 AS DOUBLE) AS x1, "
             "y + CAST(c_custkey % 5 + 12 AS DOUBLE) AS y1 FROM sites)")
SQL_YARDS = ("yards AS (SELECT *, x + CAST(s_suppkey % 7 + 20 AS DOUBLE) AS x1, "
             "y + CAST(s_suppkey % 5 + 12 AS DOUBLE) AS y1 FROM depots)")
SQL_PATHS = ("paths AS (SELECT o_orderkey, "
             "CAST((o_orderkey * 37) % 3600 AS DOUBLE) / 10 - 180 AS xa, "
             "CAST((o_orderkey * 53) % 1700 AS DOUBLE) / 10 - 85 AS ya, "
             "CAST(((o_orderkey + 1) * 37) % 3600 AS DOUBLE) / 10 - 180 AS xb, "
             "CAST(((o_orderkey + 1) * 53) % 1700 AS DOUBLE) / 10 - 85 AS yb FROM orders)")
