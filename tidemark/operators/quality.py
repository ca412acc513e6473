"""Key checks, references between tables and column profiles."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators._columns import names, require_columns


def _any_null(keys: list[str]):
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def pk_violations(df: DataFrame, keys: str | Iterable[str]) -> DataFrame:
    """Keys that are NULL or occur more than once, with their row count ``n``.

    One aggregate: a hot key reaches the shuffle as one partial count per task.
    """
    keys = names(keys)
    require_columns(df, keys)
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counted.filter((F.col("n") > 1) | _any_null(keys))


def unique_violations(df: DataFrame, keys: str | Iterable[str]) -> DataFrame:
    """Keys that occur more than once; a NULL is never equal to another NULL."""
    keys = names(keys)
    require_columns(df, keys)
    return df.dropna(subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def fk_orphans(child: DataFrame, parent: DataFrame, child_key: str | Iterable[str],
               parent_key: str | Iterable[str]) -> DataFrame:
    """Child keys without a parent, with their row count ``n``; NULL keys are fine.

    The child is counted per key first, so a key that holds most rows joins as one row.
    """
    child_key, parent_key = names(child_key), names(parent_key)
    if len(child_key) != len(parent_key) or not child_key:
        raise ValueError("child_key and parent_key must pair up")
    counted = child.dropna(subset=child_key).groupBy(*child_key).agg(
        F.count(F.lit(1)).alias("n"))
    side = parent.select(*[F.col(p).alias(f"_parent_{i}") for i, p in enumerate(parent_key)])
    on = reduce(lambda a, b: a & b,
                [F.col(c) == F.col(f"_parent_{i}") for i, c in enumerate(child_key)])
    return counted.join(side, on, "left_anti")


def column_profile(df: DataFrame, columns: Iterable[str] | None = None,
                   exact_distinct: bool = False) -> DataFrame:
    """One row per column: rows, NULLs, distinct values, smallest and largest as text.

    Without ``exact_distinct`` everything comes from one pass that shuffles a row per
    task, and distinct values are estimated.  Exact counts come from (column, value) pairs
    that are deduplicated before they are counted, so no column has to fit on one task and
    a value that fills most rows is shuffled once per task.
    """
    columns = names(columns) or df.columns
    simple = [f for f in df.schema.fields if f.name in columns and not isinstance(
        f.dataType, (T.ArrayType, T.MapType, T.StructType, T.BinaryType))]

    def of(field: T.StructField, no: int):
        column = F.col(f"`{field.name}`")
        return F.struct(
            F.lit(no).alias("no"), F.lit(field.name).alias("column_name"),
            F.count(F.lit(1)).alias("n_rows"),
            (F.count(F.lit(1)) - F.count(column)).alias("n_null"),
            F.min(column).cast("string").alias("min_value"),
            F.max(column).cast("string").alias("max_value"),
            *([] if exact_distinct else [F.approx_count_distinct(column).alias("n_distinct")]))

    plain = df.agg(F.array(*[of(f, i) for i, f in enumerate(simple)]).alias("p")).select(
        F.inline("p"))
    order = ["column_name", "n_rows", "n_null", "n_distinct", "min_value", "max_value"]
    if not exact_distinct:
        return plain.select(*order)
    pairs = F.array(*[
        F.struct(F.lit(i).alias("no"), F.col(f"`{f.name}`").cast("string").alias("text"))
        for i, f in enumerate(simple)])
    distinct = df.select(F.explode(pairs).alias("p")).select("p.no", "p.text").where(
        "text is not null").distinct().groupBy("no").agg(F.count(F.lit(1)).alias("n_distinct"))
    # one row per column on both sides
    return plain.join(distinct, "no", "left").fillna(0, ["n_distinct"]).select(*order)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table with its exact row count."""
    counts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
              for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)
