"""Small helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def as_column(value: Column | str) -> Column:
    """A column from a ``Column`` or a SQL fragment."""
    return value if isinstance(value, Column) else F.expr(value)


def named(aggregates: Mapping[str, Column | str]) -> list[Column]:
    if not aggregates:
        raise ValueError("at least one aggregate is required")
    return [as_column(expr).alias(name) for name, expr in aggregates.items()]


def names(value: str | Iterable[str] | None) -> list[str]:
    """A list of column names from one name or several."""
    if value is None:
        return []
    return [value] if isinstance(value, str) else list(value)


def require_columns(df: DataFrame, columns: Iterable[str]) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"unknown columns: {', '.join(missing)}")


def _holds_map(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.ArrayType):
        return _holds_map(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return any(_holds_map(f.dataType) for f in dtype.fields)
    return isinstance(dtype, T.MapType)


def hashable(df: DataFrame, columns: Iterable[str] | None = None) -> list[Column]:
    """The columns in a form that hashes; maps do not, so they are taken as text."""
    chosen = set(columns) if columns is not None else set(df.columns)
    return [F.col(f"`{f.name}`").cast("string") if _holds_map(f.dataType) else F.col(f"`{f.name}`")
            for f in df.schema.fields if f.name in chosen]


def spread(df: DataFrame, columns: Iterable[str] | None = None) -> Column:
    """A hash for spreading rows that share a join key over several tasks.

    The partition number splits copies of one row too.  Unlike a random number, the
    hash gives a row the same place when its task runs again after an executor is lost.
    """
    return F.xxhash64(F.spark_partition_id(), *hashable(df, columns))
