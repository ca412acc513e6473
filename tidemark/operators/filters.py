"""Filters, ordering and paging."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.timebucket import naive_utc
from tidemark.operators._columns import as_column, names, require_columns

# Offsets up to here are left to Spark's own top-n.
SEEK_FROM = 100_000
# Rows sampled for cuts, and values taken as cuts of one aggregate.
_SAMPLED, _VALUES = 500, 32
# Types whose values survive the way to text and back.
_CUT_TYPES = (T.NumericType, T.StringType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def equals_all(df: DataFrame, where: Mapping[str, Any]) -> Column:
    """``col = value AND …``.  A ``None`` value matches nothing, as ``=`` does in SQL."""
    require_columns(df, where)
    condition = F.lit(True)
    for name, value in where.items():
        condition = condition & (F.col(name) == literal(value, df.schema[name].dataType))
    return condition


def literal(value: Any, dtype: T.DataType) -> Column:
    """A value in a column's type; times are taken in UTC."""
    if isinstance(value, (dt.datetime, dt.date)):
        value = naive_utc(value).isoformat(sep=" ")
    return F.lit(value).cast(dtype)


def where_dict(df: DataFrame, where: Mapping[str, Any] | None) -> DataFrame:
    return df.filter(equals_all(df, where)) if where else df


def raw_predicate(df: DataFrame, where: Column | str | None) -> DataFrame:
    """Filter by a column or a SQL fragment; the fragment is parenthesised."""
    if where is None:
        return df
    return df.filter(where if isinstance(where, Column) else F.expr(f"({where})"))


def exists_rows(df: DataFrame, where: Mapping[str, Any]) -> DataFrame:
    """One row with ``found``: whether any row matches.  Stops at the first match."""
    if not where:
        raise ValueError("where must not be empty")
    hit = where_dict(df, where).select(F.lit(1).alias("hit")).limit(1)
    return hit.agg((F.count(F.lit(1)) > 0).alias("found"))


def count_where(df: DataFrame, where: Mapping[str, Any] | None = None) -> DataFrame:
    return where_dict(df, where).agg(F.count(F.lit(1)).alias("n"))


def newer_than(df: DataFrame, column: str, mark: Any | None) -> DataFrame:
    """Rows strictly above a high-water mark; everything when there is none."""
    if mark is None:
        return df
    if isinstance(mark, (dt.datetime, dt.date)):
        mark = naive_utc(mark).isoformat(sep=" ")
    return df.filter(F.col(column) > F.lit(mark).cast(df.schema[column].dataType))


def _order(columns: list[str], descending: bool) -> list[Column]:
    # NULLs are the largest values: last ascending, first descending.  The direction
    # belongs to the last column only.
    keys = [F.col(c).asc_nulls_last() for c in columns]
    if descending:
        keys[-1] = F.col(columns[-1]).desc_nulls_first()
    return keys


def _cuts(name: str, value: str | None, dtype: T.DataType, down: bool) -> tuple[Column, Column]:
    """Whether a row comes before a value of a column, and whether it comes before it or with it."""
    column = F.col(f"`{name}`")
    if value is None:
        return (F.lit(False), column.isNull()) if down else (column.isNotNull(), F.lit(True))
    bound = F.lit(value).cast(dtype)
    if down:
        return F.coalesce(column > bound, F.lit(True)), F.coalesce(column >= bound, F.lit(True))
    return F.coalesce(column < bound, F.lit(False)), F.coalesce(column <= bound, F.lit(False))


def _sought(df: DataFrame, keys: list[str], descending: bool, offset: int, seek_from: int) -> tuple[DataFrame, int]:
    """The rows from some place before the page on, and the page's offset among them.

    Values of a key column cut the rows into intervals; the rows before each cut are counted exactly in one
    aggregate, and the interval that holds the page's start is cut again.  Where the start lies among equal values,
    the next key column cuts those.  The sampled values decide how even the cuts are, never the result.
    It ends at ``seek_from`` rows, when the columns are used up, or at one whose type has no text form.
    """
    here, later, skip = F.lit(True), F.lit(False), offset
    size = df.count()
    for number, name in enumerate(keys):
        dtype = df.schema[name].dataType
        down = descending and number == len(keys) - 1
        if not isinstance(dtype, _CUT_TYPES):
            break
        tied = False
        while skip > seek_from and size and not tied:
            inside = df.filter(here).select(F.col(f"`{name}`").alias(name))
            some = inside.sample(min(1.0, _SAMPLED / size), seed=17).distinct()
            values = [r[0] for r in some.orderBy(*_order([name], down)).select(
                F.col(f"`{name}`").cast("string")).collect()]
            values = values[::max(1, len(values) // _VALUES)]
            cuts = [cut for value in values for cut in _cuts(name, value, dtype, down)]
            if not cuts:
                break
            counts = list(inside.agg(*[F.count_if(c).alias(f"n{i}") for i, c in enumerate(cuts)]).first())
            last = max((i for i, n in enumerate(counts) if n <= skip), default=-1)
            upper = cuts[last + 1] if last + 1 < len(cuts) else F.lit(True)
            later = later | (here & ~upper)
            size = (counts[last + 1] if last + 1 < len(cuts) else size) - (counts[last] if last >= 0 else 0)
            if last >= 0:
                here, skip = here & ~cuts[last], skip - counts[last]
            here = here & upper
            # cuts come in pairs: between the two of a pair lie the rows of one value
            tied = last >= 0 and last % 2 == 0
        if not tied:
            break
    return df.filter(here | later), skip


def paginate(
    df: DataFrame,
    order_by: str | Iterable[str],
    limit: int = 100,
    offset: int = 0,
    where: Mapping[str, Any] | None = None,
    columns: Iterable[str] | None = None,
    descending: bool = False,
    seek_from: int = SEEK_FROM,
) -> DataFrame:
    """One page of the ordered rows.

    An offset above ``seek_from`` is first brought below it by counting (see :func:`_sought`), so that
    ``seek_from + limit`` rows at most go through one task, however deep the page lies.
    """
    if limit < 0 or offset < 0:
        raise ValueError("limit and offset must not be negative")
    page = where_dict(df, where)
    if offset > seek_from:
        page, offset = _sought(page, names(order_by), descending, offset, seek_from)
    ordered = page.orderBy(*_order(names(order_by), descending))
    ordered = ordered.offset(offset).limit(limit) if offset else ordered.limit(limit)
    return ordered.select(*columns) if columns else ordered


def structured_select(
    df: DataFrame,
    columns: Iterable[str] | None = None,
    where: Column | str | None = None,
    order_by: str | Column | Iterable[str | Column] | None = None,
    limit: int | None = None,
    offset: int | None = None,
) -> DataFrame:
    """Columns, raw predicate, order, limit and offset of one table."""
    out = raw_predicate(df, where)
    if order_by is not None:
        keys = [order_by] if isinstance(order_by, (str, Column)) else list(order_by)
        out = out.orderBy(*[_sort_key(k) for k in keys])
    if offset:
        out = out.offset(offset)
    if limit is not None:
        out = out.limit(limit)
    return out.select(*columns) if columns else out


def _sort_key(key: str | Column) -> Column:
    if isinstance(key, Column):
        return key
    parts = key.strip().rsplit(None, 1)
    if len(parts) == 2 and parts[1].upper() in ("ASC", "DESC"):
        column = as_column(parts[0])
        return column.desc_nulls_first() if parts[1].upper() == "DESC" else column.asc_nulls_last()
    return as_column(key).asc_nulls_last()


def first_row(df: DataFrame) -> DataFrame:
    """At most one row."""
    return df.limit(1)


def first_value(df: DataFrame) -> DataFrame:
    """At most one row with only the first column."""
    return df.select(df.columns[0]).limit(1)


def bbox_filter(
    df: DataFrame, geom: str, xmin: float, ymin: float, xmax: float, ymax: float
) -> DataFrame:
    """Rows whose geometry lies within the envelope.

    A geometry that only lies on the envelope's border is not within it.  The test reads
    nothing but the four box numbers, which parquet can skip row groups by.
    """
    box = F.col(geom)["bbox"]
    inside = (
        (box["xmin"] >= xmin) & (box["xmax"] <= xmax) & (box["ymin"] >= ymin) & (box["ymax"] <= ymax)
    )
    meets = (box["xmin"] < xmax) & (box["xmax"] > xmin) & (box["ymin"] < ymax) & (box["ymax"] > ymin)
    return df.filter(inside & meets)
