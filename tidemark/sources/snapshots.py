"""Snapshots of several tables, and restoring them."""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.sources.tables import Tables


def _chosen(available: Iterable[str], include, exclude) -> list[str]:
    wanted = list(include) if include is not None else list(available)
    skipped = set(exclude or ())
    return [t for t in wanted if t not in skipped]


def save(tables: Tables, names: Iterable[str], path: str, include: Iterable[str] | None = None,
         exclude: Iterable[str] | None = None, schema_only: bool = False,
         data_only: bool = False) -> list[str]:
    """Copy tables to ``path``: one parquet folder each, and a list of their schemas."""
    if schema_only and data_only:
        raise ValueError("schema_only and data_only exclude each other")
    spark, chosen = tables.spark, _chosen(names, include, exclude)
    frames = {name: tables.read(name) for name in chosen}
    if not schema_only:
        for name, df in frames.items():
            df.write.mode("errorifexists").parquet(f"{path}/data/{name}")
    if not data_only:
        listing = [(name, df.schema.json()) for name, df in frames.items()]
        spark.createDataFrame(listing, "table_name string, schema string").coalesce(1).write.mode(
            "errorifexists").json(f"{path}/schemas")
    return chosen


def _schemas(spark: SparkSession, path: str) -> dict[str, T.StructType]:
    # one short row per table
    listing = spark.read.schema("table_name string, schema string").json(f"{path}/schemas")
    return {r["table_name"]: T.StructType.fromJson(json.loads(r["schema"]))
            for r in listing.collect()}


def load(tables: Tables, path: str, include: Iterable[str] | None = None,
         exclude: Iterable[str] | None = None, prefix: str = "", clean: bool = False,
         schema_only: bool = False, data_only: bool = False) -> list[str]:
    """Restore tables as ``prefix + name``.

    ``clean`` replaces existing tables; without it an existing table is an error, or gets
    the rows appended with ``data_only``.
    """
    spark = tables.spark
    schemas = _schemas(spark, path)
    chosen = _chosen(schemas, include, exclude)
    for name in chosen:
        target, schema = prefix + name, schemas[name]
        if schema_only:
            df: DataFrame = spark.createDataFrame([], schema)
        else:
            df = spark.read.schema(schema).parquet(f"{path}/data/{name}")
        if data_only:
            if clean:
                tables.truncate(target)
            tables.append(df, target)
        elif clean or not tables.exists(target):
            tables.publish(df, target)
        else:
            raise ValueError(f"table already exists: {target}")
    return [prefix + name for name in chosen]
