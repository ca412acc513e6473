"""Catalog tables with staged, all-or-nothing publication.

New contents are written to a fresh folder and the table is pointed at it, so readers see
the old or the new rows and a failed job changes nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import rows
from tidemark.operators._columns import names
from tidemark.operators.quality import pk_violations

MODES = ("fail", "replace", "append")


class KeyViolation(ValueError):
    """A table does not satisfy its key."""


def quoted(name: str) -> str:
    return ".".join(f"`{part.replace('`', '``')}`" for part in name.split("."))


def _shape(df: DataFrame) -> list[tuple]:
    return [(f.name, f.dataType) for f in df.schema.fields]


class Tables:
    """Tables whose files live under ``root``, a folder that the whole cluster can reach."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # --- reading ------------------------------------------------------------------

    def exists(self, name: str) -> bool:
        return self.spark.catalog.tableExists(name)

    def read(self, name: str) -> DataFrame:
        if not self.exists(name):
            raise ValueError(f"table does not exist: {name}")
        keyed = self.keyed(name)
        return keyed.read() if keyed else self.spark.table(quoted(name))

    def keyed(self, name: str):
        """The table, if it is dealt to segments by key (see :mod:`tidemark.sources.segments`)."""
        from tidemark.sources.segments import KeyedTable

        return KeyedTable.of(self.spark, name)

    def near(self, batch: DataFrame, name: str, keys: str | Iterable[str]) -> DataFrame:
        """The rows that may share a key with the batch: of its segments if the table has some, else all."""
        keyed = self.keyed(name)
        return keyed.near(batch, keys) if keyed else self.read(name)

    # --- writing ------------------------------------------------------------------

    def stage(self, df: DataFrame, name: str, layout: Iterable[str] = ()) -> str:
        """Write ``df`` to a fresh folder and return its path."""
        path = f"{self.root}/{name}/{uuid.uuid4().hex}"
        layout = names(layout)
        if layout:
            df = df.sortWithinPartitions(*layout)
        try:
            df.write.mode("errorifexists").parquet(path)
        except Exception:
            self.discard(path)
            raise
        return path

    def discard(self, path: str) -> None:
        """Delete a staged folder that is not published."""
        files, at = files_at(self.spark, path)
        files.delete(at, True)

    def point_at(self, name: str, path: str, like: DataFrame) -> None:
        """Make the staged folder the table's contents.

        A table whose columns change is created beside the old one and takes its name; otherwise
        the location moves.
        """
        exists = self.exists(name)
        keyed = self.keyed(name) if exists else None
        if keyed and _shape(keyed.read()) == _shape(like):
            # the staged rows are dealt to segments, so they are written twice
            keyed.overwrite(self.spark.read.schema(like.schema).parquet(path))
            self.discard(path)
            return
        if exists and (keyed or _shape(self.read(name)) != _shape(like)):
            # the new table exists before the old one goes, and a failure leaves one of them
            beside = f"{name}_{uuid.uuid4().hex}"
            self._create(beside, path, like)
            self.spark.sql(f"DROP TABLE {quoted(name)}")
            self.spark.sql(f"ALTER TABLE {quoted(beside)} RENAME TO {quoted(name)}")
            return
        if exists:
            self.spark.sql(f"ALTER TABLE {quoted(name)} SET LOCATION '{path}'")
            self.spark.catalog.refreshTable(name)
            return
        self._create(name, path, like)

    def _create(self, name: str, path: str, like: DataFrame) -> None:
        columns = ", ".join(
            f"`{f.name}` {f.dataType.simpleString()}" for f in like.schema.fields)
        self.spark.sql(
            f"CREATE TABLE {quoted(name)} ({columns}) USING parquet LOCATION '{path}'")

    def remove_old_versions(self, name: str) -> int:
        """Delete folders that the table pointed at before; returns how many.

        For a time when nobody reads an older version any more.
        """
        current = location_of(self.spark, name).rsplit("/", 1)[-1]
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        home = hadoop.Path(f"{self.root}/{name}")
        files = home.getFileSystem(self.spark._jsc.hadoopConfiguration())
        old = [s.getPath() for s in files.listStatus(home) if s.getPath().getName() != current]
        for folder in old:
            files.delete(folder, True)
        return len(old)

    def publish(self, df: DataFrame, name: str, layout: Iterable[str] = ()) -> int:
        """Replace the table's rows (creating the table); returns the row count."""
        watch = Watch(df)
        self.point_at(name, self.stage(watch.df, name, layout), df)
        return watch.n

    def create_keyed(self, df: DataFrame, name: str, keys: str | Iterable[str], segments: int) -> int:
        """Write a frame to a new table dealt to segments by key; returns the row count.

        Upserts by that key, inserts, deletes, updates and streams then rewrite or look into the segments
        they touch; other tables are rewritten as a whole.
        """
        from tidemark.sources.segments import KeyedTable

        return KeyedTable.create(self.spark, name, df, keys, segments, f"{self.root}/{name}/{uuid.uuid4().hex}").append(df)

    def append(self, df: DataFrame, name: str) -> int:
        """Add rows, aligned to the table's columns; returns the row count."""
        return self.append_watched(df, name).n

    def append_watched(self, df: DataFrame, name: str) -> "Watch":
        aligned = rows.align(df, self.read(name).schema)
        keyed = self.keyed(name)
        if keyed:
            return keyed.append_watched(aligned)
        watch = Watch(aligned)
        watch.df.write.insertInto(quoted(name))
        return watch

    def write(
        self,
        df: DataFrame,
        name: str,
        if_exists: str = "fail",
        dtype: Mapping[str, str] | None = None,
        primary_key: str | Iterable[str] | None = None,
    ) -> int:
        """Write a frame: fail if the table exists, replace it, or append to it.

        NaN becomes NULL.  ``dtype`` casts columns.  Unless appending, ``primary_key`` is
        checked on the staged rows before they are published.
        """
        if if_exists not in MODES:
            raise ValueError(f"if_exists must be one of {', '.join(MODES)}")
        df = rows.nan_to_null(df)
        for column, kind in (dtype or {}).items():
            df = df.withColumn(column, F.col(column).cast(kind))
        if if_exists == "append" and self.exists(name):
            return self.append(df, name)
        if if_exists == "fail" and self.exists(name):
            raise ValueError(f"table already exists: {name}")
        watch = Watch(df)
        path = self.stage(watch.df, name)
        if primary_key is not None:
            try:
                self._check_key(self.spark.read.schema(df.schema).parquet(path), primary_key)
            except KeyViolation:
                self.discard(path)
                raise
        self.point_at(name, path, df)
        return watch.n

    @staticmethod
    def _check_key(df: DataFrame, key: str | Iterable[str]) -> None:
        broken = pk_violations(df, key).limit(1).collect()
        if broken:
            raise KeyViolation(f"primary key violated: {broken[0].asDict()}")

    def insert_ignore(self, batch: DataFrame, name: str, keys: str | Iterable[str]) -> int:
        """Append the batch rows whose key is new; returns how many."""
        return self.append(rows.insert_ignore(self.near(batch, name, keys), batch, keys), name)

    def upsert(self, batch: DataFrame, name: str, keys: str | Iterable[str],
               update: Iterable[str] | None = None, **options) -> int:
        """Merge the batch into the table; returns the inserted and updated rows.

        An empty batch writes nothing.  A keyed table rewrites the segments that the batch touches, any other
        table all of its rows.
        """
        keyed = self.keyed(name)
        if keyed:
            return keyed.upsert(batch, keys, update, **options)["n"] or 0
        if batch.isEmpty():
            return 0
        merged = rows.upsert(self.read(name), batch, keys, update, mark="_changed", **options)
        watch = Watch(merged, n=F.sum(F.col("_changed").cast("long")))
        rewritten = watch.df.drop("_changed")
        self.point_at(name, self.stage(rewritten, name), rewritten)
        return watch.n

    def delete(self, name: str, where: Mapping[str, Any] | Column | str) -> int:
        """Delete matching rows; returns how many."""
        keyed = self.keyed(name)
        if keyed:
            return keyed.delete(where)
        return self._rewrite(name, where, lambda df, hit: df.filter(~hit))

    def update(self, name: str, values: Mapping[str, Any],
               where: Mapping[str, Any] | Column | str) -> int:
        """Update matching rows; returns how many."""
        keyed = self.keyed(name)
        if keyed:
            return keyed.update(values, where)
        return self._rewrite(
            name, where, lambda df, hit: rows.update_where(df, values, hit).drop("_hit"))

    def _rewrite(self, name: str, where, change) -> int:
        current = self.read(name)
        hit = rows._condition(current, where)
        # a condition that matches nothing, often decided by file statistics, rewrites nothing
        if current.filter(hit).isEmpty():
            return 0
        watch = Watch(current.withColumn("_hit", hit), n=F.sum(F.col("_hit").cast("long")))
        changed = change(watch.df, F.col("_hit")).drop("_hit")
        self.point_at(name, self.stage(changed, name), changed)
        return watch.n

    def truncate(self, name: str) -> None:
        empty = rows.truncate(self.read(name))
        self.point_at(name, self.stage(empty, name), empty)


def location_of(spark: SparkSession, name: str) -> str:
    return described_location(spark, quoted(name))


def described_location(spark: SparkSession, what: str) -> str:
    """Location of a table or, with a partition spec behind its name, of a partition.

    The few lines of the description are read as they are, as a filter on them would start a job.
    Columns come first, so one of that name is passed over.
    """
    lines = [(r["col_name"], r["data_type"]) for r in spark.sql(f"DESCRIBE TABLE EXTENDED {what}").collect()]
    start = next(i for i, (title, _) in enumerate(lines) if title.startswith("# Detailed"))
    return next(value for title, value in lines[start:] if title == "Location").rstrip("/")


def files_at(spark: SparkSession, folder: str):
    """The file system of a folder, and its path there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


class Watch:
    """Measures of a frame, taken while its rows are written.

    ``df`` is the frame to write, and the observing step has to stay the last one before the
    write: below a shuffle it would count again what Spark reads twice.  When nothing reaches it,
    adaptive execution may drop it; the measures are then computed by a query of their own.
    """

    def __init__(self, df: DataFrame, **measures: Column):
        self.plain = df
        self.columns = [c.alias(n) for n, c in (measures or {"n": F.count(F.lit(1))}).items()]
        self.seen = Observation()
        self.df = df.observe(self.seen, *self.columns)

    def get(self) -> dict[str, Any]:
        try:
            found = self.seen.get
        except Py4JJavaError:
            found = {}
        return found or self.plain.agg(*self.columns).first().asDict()

    @property
    def n(self) -> int:
        return self.get()["n"] or 0
