"""Tables dealt to segments by their key, so that a change of a few rows rewrites a few segments.

A segment is a partition of the table: ``key_segment`` is a hash of the key modulo the number of
segments.  A batch names its segments by its keys alone, without reading the table, and all
other segments keep their files.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import rows
from tidemark.operators._columns import names, require_columns
from tidemark.operators.filters import literal
from tidemark.sources.partitions import PartitionedTable
from tidemark.sources.tables import Watch, quoted

SEGMENT = "key_segment"
# Segments are catalog partitions, and lists of them reach the driver.
MOST_SEGMENTS = 65_536
PROPERTY = "tidemark.segments"


class KeyedTable(PartitionedTable):
    """A catalog table partitioned by ``key_segment``; made by :meth:`create`, found by :meth:`of`.

    ``segments`` is fixed when the table is created: a change rewrites whole segments, so one should hold
    what a few tasks write in seconds (some hundred MB), with 65 536 at most.  NULL is a key value like any other here.
    """

    def __init__(self, spark: SparkSession, name: str, keys: Iterable[str], segments: int):
        self.spark, self.name = spark, name
        self.keys, self.segments = list(keys), segments

    @classmethod
    def create(cls, spark: SparkSession, name: str, like: DataFrame, keys: str | Iterable[str], segments: int,
               path: str) -> "KeyedTable":
        """An empty table with the columns of ``like``, its files under ``path``."""
        keys = names(keys)
        if not keys:
            raise ValueError("key columns are required")
        require_columns(like, keys)
        if isinstance(segments, bool) or not isinstance(segments, int) or not 1 <= segments <= MOST_SEGMENTS:
            raise ValueError(f"segments must be a whole number from 1 to {MOST_SEGMENTS}")
        if SEGMENT in like.columns:
            raise ValueError(f"{SEGMENT} is the name of the segment column")
        if spark.catalog.tableExists(name):
            raise ValueError(f"table already exists: {name}")
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in like.schema)
        noted = json.dumps({"keys": keys, "segments": segments}).replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"CREATE TABLE {quoted(name)} ({columns}, {SEGMENT} int) USING parquet PARTITIONED BY ({SEGMENT}) "
                  f"LOCATION '{path}' TBLPROPERTIES ('{PROPERTY}' = '{noted}')")
        return cls(spark, name, keys, segments)

    @classmethod
    def of(cls, spark: SparkSession, name: str) -> "KeyedTable | None":
        """The table of that name, if it is dealt to segments."""
        if SEGMENT not in spark.table(quoted(name)).columns:
            return None
        noted = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {quoted(name)}").collect()}
        return cls(spark, name, **json.loads(noted[PROPERTY])) if PROPERTY in noted else None

    # --- reading ------------------------------------------------------------------

    @property
    def _table(self) -> DataFrame:
        return self.spark.table(quoted(self.name))

    def read(self) -> DataFrame:
        return self._table.drop(SEGMENT)

    def near(self, batch: DataFrame, keys: str | Iterable[str] | None = None) -> DataFrame:
        """The rows of the segments that the batch's keys are in; all rows if ``keys`` says less than the table's key."""
        if not self._told(names(keys) or self.keys, batch):
            return self.read()
        return self._rows(self._segments_of(batch)).drop(SEGMENT)

    # --- changing -----------------------------------------------------------------

    def append(self, df: DataFrame) -> int:
        """Add rows, aligned to the table's columns; returns the row count."""
        return self.append_watched(df).n

    def append_watched(self, df: DataFrame) -> Watch:
        watch = Watch(self._dealt(rows.align(df, self.read().schema)))
        watch.df.write.insertInto(quoted(self.name))
        return watch

    def overwrite(self, df: DataFrame) -> int:
        """Put these rows in the place of all rows; returns the row count."""
        watch = Watch(self._dealt(rows.align(df, self.read().schema)))
        return self._publish(watch, None)["n"] or 0

    def insert_ignore(self, batch: DataFrame, keys: str | Iterable[str]) -> int:
        """Append the batch rows whose key is new; looks only into the batch's segments."""
        return self.append(rows.insert_ignore(self.near(batch, keys), batch, keys))

    def upsert(self, batch: DataFrame, keys: str | Iterable[str], update: Iterable[str] | None = None,
               measured: Mapping[str, Column] | None = None, **options) -> dict[str, Any]:
        """Merge the batch and rewrite the segments it touches; returns ``n``, the rows inserted and updated.

        ``keys`` that contain the table's own key say which segments those are; any other key reads and
        rewrites all of them.  ``measured`` adds aggregates over the merged rows, where ``_changed``
        tells a changed row.  An empty batch writes nothing.
        """
        told = self._told(names(keys), batch)
        touched = self._segments_of(batch) if told else None
        if batch.isEmpty() if touched is None else not touched:
            return {"n": 0}
        merged = rows.upsert(self._rows(touched).drop(SEGMENT), batch, keys, update, mark="_changed", **options)
        measures = {"n": F.sum(F.col("_changed").cast("long")), **(measured or {})}
        return self._publish(Watch(self._dealt(merged), **measures), touched)

    def delete(self, where: Mapping[str, Any] | Column | str) -> int:
        """Delete matching rows, rewriting the segments that hold any; returns how many."""
        hit, found = self._hits(where)
        if found:
            # what is left is watched for nothing but the write; the hits are counted already
            self._publish(Watch(self._dealt(self._rows(found).filter(~hit).drop(SEGMENT))), set(found))
        return sum(found.values())

    def update(self, values: Mapping[str, Any], where: Mapping[str, Any] | Column | str) -> int:
        """Update matching rows, rewriting the segments that hold any; returns how many.

        Rows whose key changes move, so the segments they go to are rewritten too.
        """
        hit, found = self._hits(where)
        if not found:
            return 0
        touched = set(found)
        if set(values) & set(self.keys):
            moved = rows.update_where(self._rows(found).filter(hit).drop(SEGMENT), values, F.lit(True))
            touched |= self._segments_of(moved)
        changed = rows.update_where(self._rows(touched).drop(SEGMENT), values, hit)
        self._publish(Watch(self._dealt(changed)), touched)
        return sum(found.values())

    # --- segments -----------------------------------------------------------------

    def _segment(self, df: DataFrame) -> Column:
        """The segment of a row; keys are hashed in the table's types, as the hash of a number depends on its type."""
        kinds = self._table.schema
        return F.pmod(F.hash(*[F.col(f"`{k}`").cast(kinds[k].dataType) for k in self.keys]),
                      F.lit(self.segments))

    def _dealt(self, df: DataFrame) -> DataFrame:
        """Rows with their segment; AQE cuts a segment that holds most of the rows into several tasks."""
        return df.withColumn(SEGMENT, self._segment(df)).hint("rebalance", F.col(SEGMENT))

    def _told(self, keys: list[str], batch: DataFrame) -> bool:
        return set(self.keys) <= set(keys) and set(self.keys) <= set(batch.columns)

    def _segments_of(self, df: DataFrame) -> set[int]:
        return {r[0] for r in df.select(self._segment(df).alias(SEGMENT)).distinct().collect()}

    def _rows(self, segments: Iterable[int] | None) -> DataFrame:
        """Rows of the segments; the literals prune the catalog's partitions."""
        if segments is None:
            return self._table
        listed = ", ".join(map(str, sorted(segments)))
        return self._table.filter(f"{SEGMENT} IN ({listed})" if listed else "false")

    def _hits(self, where) -> tuple[Column, dict[int, int]]:
        """The condition, and the number of rows it matches by segment.

        An equality on the whole key opens one segment; any other condition reads its own columns of all.
        """
        hit = rows._condition(self.read(), where)
        searched = self._table
        if isinstance(where, Mapping) and set(self.keys) <= set(where):
            kinds = self._table.schema
            key = self.spark.range(1).select(*[literal(where[k], kinds[k].dataType).alias(k) for k in self.keys])
            searched = self._rows(self._segments_of(key))
        counted = searched.filter(hit).groupBy(SEGMENT).agg(F.count(F.lit(1)).alias("n"))
        return hit, {r[SEGMENT]: r["n"] for r in counted.collect()}

    def _publish(self, watch: Watch, touched: set[int] | None) -> dict[str, Any]:
        """Stage the watched rows and swap them in; returns the measures."""
        listed = {r["partition"] for r in self._partitions().collect()}
        wanted = None if touched is None else {f"{SEGMENT}={n}" for n in touched}
        staged = self.stage(watch.df.select(*self._table.columns))
        if wanted is not None and not set(staged.written) <= wanted:
            self.discard(staged)
            raise RuntimeError("the batch gave other keys when it was read again; nothing was changed")
        measures = watch.get()
        self.swap(staged, listed if wanted is None else listed & wanted)
        return measures

    def _partition_columns(self, df: DataFrame) -> list[str]:
        return [SEGMENT]

    def _spec(self, path: str) -> str:
        return f"PARTITION ({SEGMENT} = {int(path.partition('=')[2])})"
