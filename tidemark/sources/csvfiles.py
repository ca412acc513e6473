"""CSV in and out."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.sources.tables import Tables, Watch


def _options(delimiter: str, header: bool, null_string: str, encoding: str) -> dict:
    if len(delimiter) != 1:
        raise ValueError("delimiter must be one character")
    return {"sep": delimiter, "header": header, "nullValue": null_string, "encoding": encoding,
            "quote": '"', "escape": '"',
            "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
            "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]",
            "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][XXX]"}


def export_csv(df: DataFrame, path: str, columns: Iterable[str] | None = None,
               delimiter: str = ",", header: bool = True, null_string: str = "",
               encoding: str = "UTF-8") -> int:
    """Write a folder of CSV files in parallel; returns the row count."""
    out = df.select(*columns) if columns else df
    watch = Watch(out)
    empty = {"emptyValue": '""'}
    watch.df.write.mode("errorifexists").options(
        **_options(delimiter, header, null_string, encoding), **empty).csv(path)
    return watch.n


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, delimiter: str = ",",
             header: bool = True, null_string: str = "", encoding: str = "UTF-8",
             multi_line: bool = False) -> DataFrame:
    """Read CSV with a given schema (never inferred); a malformed row is an error.

    Spark splits large files.  ``multi_line=True`` reads quoted line breaks, which makes a file one
    task; exports are written as many files.
    """
    # with NULL written as nothing, only an unquoted empty field is NULL: a text that no
    # file holds keeps the quoted one from being taken for NULL as well
    absent = null_string or uuid.uuid4().hex
    return spark.read.schema(schema).options(
        **_options(delimiter, header, absent, encoding), mode="FAILFAST",
        emptyValue="", multiLine=multi_line).csv(path)


def import_csv(tables: Tables, path: str, table: str, columns: Iterable[str] | None = None,
               **options) -> int:
    """Append CSV rows to an existing table; returns the row count."""
    target = tables.read(table).schema
    wanted = list(columns) if columns else target.names
    unknown = [c for c in wanted if c not in target.names]
    if unknown:
        raise ValueError(f"columns not in the target: {', '.join(unknown)}")
    schema = T.StructType([target[c] for c in wanted])
    return tables.append(read_csv(tables.spark, path, schema, **options), table)
