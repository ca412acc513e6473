"""Free SQL with bound parameters."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession


def sql(spark: SparkSession, text: str, params: Mapping[str, Any] | Sequence[Any] | None = None,
        **frames: DataFrame) -> DataFrame:
    """Run SQL; ``:name`` or ``?`` are bound values, ``{name}`` a frame given by keyword."""
    text = re.sub(r";\s*$", "", text)
    args = dict(params) if isinstance(params, Mapping) else list(params or [])
    return spark.sql(text, args=args or None, **frames)


def table_or_sql(spark: SparkSession, table: str | None = None, query: str | None = None,
                 params: Mapping[str, Any] | Sequence[Any] | None = None) -> DataFrame:
    """A whole table or a query's result: exactly one of the two."""
    if (table is None) == (query is None):
        raise ValueError("give exactly one of table and query")
    return spark.table(table) if table is not None else sql(spark, query, params)
