"""Continuous aggregates: bucketed aggregates kept in a table and refreshed by window."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.intervals import interval
from tidemark.functions.timebucket import (
    index_of,
    naive_utc,
    start_of,
    time_bucket,
    time_literal,
)
from tidemark.operators.timeseries import time_bucket_agg, time_range
from tidemark.sources.chunks import CHUNK, ChunkedTable
from tidemark.sources.tables import quoted


@dataclass(frozen=True)
class ContinuousAggregate:
    """What is aggregated: ``source`` gives the rows, ``by`` further group columns."""

    name: str
    source: Callable[[SparkSession], DataFrame]
    time: str
    width: str
    aggregates: Mapping[str, Column | str]
    by: tuple[str, ...] = ()
    materialized_only: bool = True
    # buckets are stored in partitions of this length, so that a refresh rewrites few
    chunk_interval: str = "30 days"
    # kept out of equality: columns do not compare
    where: Column | str | None = field(default=None, compare=False)

    def __post_init__(self):
        interval(self.width)
        if not self.aggregates:
            raise ValueError("a continuous aggregate needs aggregates")

    def aggregate(self, rows: DataFrame) -> DataFrame:
        return time_bucket_agg(
            rows, self.time, self.width, self.aggregates, self.by, self.where)


class Materialization:
    """The stored buckets of a continuous aggregate."""

    def __init__(self, spark: SparkSession, definition: ContinuousAggregate):
        self.spark, self.of = spark, definition
        self.table = ChunkedTable(spark, definition.name, "bucket", definition.chunk_interval)

    def create(self, path: str, with_no_data: bool = False) -> "Materialization":
        """Create the bucket table; unless ``with_no_data``, fill it from the whole source."""
        buckets = self.of.aggregate(self.of.source(self.spark))
        self.table.create(buckets, path, migrate_data=not with_no_data)
        return self

    def stored(self) -> DataFrame:
        return self.spark.table(quoted(self.of.name)).drop(CHUNK)

    def refresh(self, start: dt.datetime | None, end: dt.datetime | None) -> None:
        """Recompute the buckets that lie fully inside ``[start, end)``; None is open."""
        for bound in (start, end):
            if bound is not None and not isinstance(bound, (dt.datetime, dt.date)):
                raise TypeError("window bounds must be datetimes or None")
        if start is not None and end is not None and naive_utc(start) >= naive_utc(end):
            raise ValueError("the window start must be before its end")
        first, stop = self._inside(start, end)
        if first is not None and stop is not None and first >= stop:
            return

        fresh = self.of.aggregate(
            time_range(self.of.source(self.spark), self.of.time, first, stop))
        whole = self.spark.table(quoted(self.of.name))
        near = self._chunks_of(whole, first, stop)
        outside = near.filter(~self._in_window(near, "bucket", first, stop)).drop(CHUNK)
        placed = fresh.unionByName(outside).select(
            *outside.columns, time_bucket(F.col("bucket"), self.of.chunk_interval).alias(CHUNK))
        before = self._stored_chunks(first, stop)
        self.table.replace(placed.hint("rebalance", F.col(CHUNK)), [path for _, path in before])

    def _inside(self, start, end):
        """The window shrunk to whole buckets."""
        width = self.of.width
        first = stop = None
        if start is not None:
            at = index_of(start, width)
            first = start_of(at, width)
            if first < naive_utc(start):
                first = start_of(at + 1, width)
        if end is not None:
            stop = start_of(index_of(end, width), width)
        return first, stop

    @staticmethod
    def _in_window(df: DataFrame, column: str, first, stop) -> Column:
        dtype = df.schema[column].dataType
        keep = F.lit(True)
        if first is not None:
            keep = keep & (F.col(column) >= time_literal(first, dtype))
        if stop is not None:
            keep = keep & (F.col(column) < time_literal(stop, dtype))
        return keep

    def _chunks_of(self, table: DataFrame, first, stop) -> DataFrame:
        """Partitions that the window touches."""
        width = self.of.chunk_interval
        low = start_of(index_of(first, width), width) if first is not None else None
        return table.filter(self._in_window(table, CHUNK, low, stop))

    def _stored_chunks(self, first, stop) -> list:
        """Partitions that the window touches, from the catalog."""
        width = self.of.chunk_interval
        low = start_of(index_of(first, width), width) if first is not None else None
        return [chunk for chunk in self.table.chunks()
                if (low is None or naive_utc(chunk[0]) >= low)
                and (stop is None or naive_utc(chunk[0]) < stop)]

    def refresh_policy(self, start_offset: str | None, end_offset: str | None,
                       now: dt.datetime | None = None) -> tuple:
        """Refresh the window that a schedule would: ``now - start_offset`` to ``now - end_offset``.

        Returns the window.
        """
        now = naive_utc(now or dt.datetime.now(dt.timezone.utc))
        window = policy_window(start_offset, end_offset, now)
        self.refresh(*window)
        return window

    def horizon(self) -> dt.datetime | None:
        """End of the last stored bucket; only the newest partition is read."""
        listed = self.table.chunks()
        if not listed:
            return None
        newest = self.spark.table(quoted(self.of.name))
        newest = newest.filter(F.col(CHUNK) == time_literal(listed[-1][0], newest.schema[CHUNK].dataType))
        last = newest.agg(F.max("bucket").alias("b")).first()["b"]
        if last is None:
            return None
        return start_of(index_of(last, self.of.width) + 1, self.of.width)

    def read(self) -> DataFrame:
        """Stored buckets; unless ``materialized_only``, plus live ones past the horizon."""
        stored = self.stored()
        if self.of.materialized_only:
            return stored
        live = time_range(self.of.source(self.spark), self.of.time, start=self.horizon())
        return stored.unionByName(self.of.aggregate(live))


def policy_window(start_offset: str | None, end_offset: str | None,
                  now: dt.datetime) -> tuple[dt.datetime | None, dt.datetime | None]:
    start = interval(start_offset) if start_offset is not None else None
    end = interval(end_offset) if end_offset is not None else None
    # months and fixed lengths do not compare without a calendar
    if start and end and start.is_calendar == end.is_calendar:
        if (start.months, start.micros) <= (end.months, end.micros):
            raise ValueError("start_offset must reach further back than end_offset")
    return (start.before(now) if start else None, end.before(now) if end else None)
