"""Tables cut into time chunks, and the jobs that look after the chunks.

A chunk is a partition of the table: ``chunk_start`` is the start of the time bucket that
holds the row.  Listing, dropping and compacting chunks touch partitions, not rows of
other chunks.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.intervals import Interval, interval
from tidemark.functions.timebucket import (
    bucket_index,
    naive_utc,
    time_bucket,
    time_literal,
)
from tidemark.operators import rows, timeseries
from tidemark.operators._columns import names, spread
from tidemark.session import estimated_bytes
from tidemark.sources.partitions import SPECS_PER_STATEMENT, PartitionedTable
from tidemark.sources.tables import Watch, files_at, quoted

CHUNK = "chunk_start"
DIMENSION = "dim_bucket"
# Empty file in the folder of a compacted partition; its name ends with the number of files.
COMPACTED = "_compacted-"
# Bytes that a task of an upsert reads: Spark counts 4 MB for every file, and a chunk's files are small.
READ_BYTES = 32 << 20
# What Spark writes for a NULL partition value.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def age_bound(value: str | dt.datetime | dt.date | None, now: dt.datetime | None) -> dt.datetime | None:
    """An age such as ``"30 days"`` counts back from ``now``; a datetime is taken as is."""
    if value is None:
        return None
    if isinstance(value, str):
        return interval(value).before(naive_utc(now or dt.datetime.now(dt.timezone.utc)))
    if isinstance(value, (dt.datetime, dt.date)):
        return naive_utc(value)
    raise TypeError("a chunk age must be an interval string or a datetime")


def with_chunk(df: DataFrame, time: str, width: str | Interval = "1 day") -> DataFrame:
    """Add ``chunk_start``.  A NULL time is an error, as chunks need a time."""
    checked = F.when(F.col(time).isNotNull(), F.col(time)).otherwise(
        F.raise_error(F.lit(f"{time} must not be NULL")).cast(df.schema[time].dataType))
    return df.withColumn(CHUNK, time_bucket(checked, width))


def hash_dimension(df: DataFrame, column: str, partitions: int) -> DataFrame:
    """Add ``dim_bucket``: a hash of the column, 0 to ``partitions - 1``."""
    if isinstance(partitions, bool) or not isinstance(partitions, int) or partitions < 1:
        raise ValueError("number of partitions must be a positive integer")
    return df.withColumn(DIMENSION, F.pmod(F.hash(F.col(column)), F.lit(partitions)))


def range_dimension(df: DataFrame, column: str, width: str | int) -> DataFrame:
    """Add ``dim_bucket``: the range of the column that holds the row.

    ``width`` is an interval for a time column and a whole number otherwise.
    """
    if isinstance(df.schema[column].dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return df.withColumn(DIMENSION, bucket_index(F.col(column), width))
    if isinstance(width, bool) or not isinstance(width, int) or width < 1:
        raise ValueError("a range dimension needs a positive whole width")
    return df.withColumn(DIMENSION, F.floor(F.col(column) / F.lit(width)))


def dimension(df: DataFrame, column: str, number_partitions: int | None = None,
              chunk_interval: str | int | None = None) -> DataFrame:
    """A hash dimension (``number_partitions``) or a range dimension (``chunk_interval``)."""
    if (number_partitions is None) == (chunk_interval is None):
        raise ValueError("give exactly one of number_partitions and chunk_interval")
    if number_partitions is not None:
        return hash_dimension(df, column, number_partitions)
    return range_dimension(df, column, chunk_interval)


def _bounds(width: Interval, older: dt.datetime | None, newer: dt.datetime | None,
            dtype: T.DataType) -> Column:
    """Chunks that end by ``older`` and start at or after ``newer``."""
    keep = F.lit(True)
    if older is not None:
        unit = ("MONTH", width.months) if width.is_calendar else ("MICROSECOND", width.micros)
        end = F.timestamp_add(unit[0], F.lit(unit[1]).cast("long"), F.col(CHUNK))
        keep = keep & (end <= time_literal(older, dtype))
    if newer is not None:
        keep = keep & (F.col(CHUNK) >= time_literal(newer, dtype))
    return keep


class ChunkedTable(PartitionedTable):
    """A catalog table partitioned by ``chunk_start`` (and optionally ``dim_bucket``)."""

    def __init__(self, spark: SparkSession, name: str, time: str,
                 chunk_interval: str | Interval = "1 day",
                 dimension_of: tuple[str, dict] | None = None):
        self.spark, self.name, self.time = spark, name, time
        self.width = interval(chunk_interval)
        # (column, arguments of :func:`dimension`) of a second partition column
        self.dimension_of = dimension_of
        self._kind = None

    # --- creating and filling -----------------------------------------------------

    def create(self, like: DataFrame, path: str, if_not_exists: bool = False,
               migrate_data: bool = False) -> "ChunkedTable":
        """Create the table under ``path``; ``migrate_data`` also loads the rows of ``like``."""
        if self.spark.catalog.tableExists(self.name):
            if if_not_exists:
                return self
            raise ValueError(f"table already exists: {self.name}")
        self._kind = None
        placed = self._place(like)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in placed.schema)
        self.spark.sql(
            f"CREATE TABLE {quoted(self.name)} ({columns}) USING parquet "
            f"PARTITIONED BY ({', '.join(self._partition_columns(placed))}) LOCATION '{path}' "
            "OPTIONS ('compression' = 'zstd')")
        if migrate_data:
            self.append(like)
        return self

    def _partition_columns(self, df: DataFrame) -> list[str]:
        return [c for c in (CHUNK, DIMENSION) if c in df.columns]

    def _place(self, df: DataFrame) -> DataFrame:
        placed = df
        if self.dimension_of:
            column, options = self.dimension_of
            placed = dimension(placed, column, **options)
        placed = with_chunk(placed, self.time, self.width)
        parts = [CHUNK] + ([DIMENSION] if self.dimension_of else [])
        return placed.select(*df.columns, *parts)

    def append(self, df: DataFrame) -> int:
        """Add rows to their chunks; returns the row count.

        The rebalance hint gathers each chunk's rows into few files; AQE cuts a chunk
        that holds most of the rows into several tasks.
        """
        placed = self._place(df)
        parts = self._partition_columns(placed)
        watch = Watch(placed)
        watch.df.hint("rebalance", *[F.col(c) for c in parts]).write.insertInto(quoted(self.name))
        return watch.n

    # --- reading ------------------------------------------------------------------

    def read(self, start: dt.datetime | None = None, finish: dt.datetime | None = None) -> DataFrame:
        """Rows of the half-open range; only the chunks it touches are opened."""
        table = self._table()
        ranged = timeseries.time_range(table, self.time, start, finish, (CHUNK, self.width))
        return ranged.drop(CHUNK, DIMENSION)

    def _table(self) -> DataFrame:
        """All columns.  Folders are listed by some tasks a core, where Spark starts one for every two of 20 000 folders."""
        conf, key = self.spark.conf, "spark.sql.sources.parallelPartitionDiscovery.parallelism"
        if conf.get(key) == "10000":
            conf.set(key, str(8 * self._cores()))
        return self.spark.table(quoted(self.name))

    def _cores(self) -> int:
        return max(2, self.spark.sparkContext.defaultParallelism)

    def _gathered(self, df: DataFrame) -> DataFrame:
        """A scan in tasks of many small files: each task of a shuffle opens a file per partition it deals to."""
        return df.coalesce(min(max(4 * self._cores(), estimated_bytes(df) // READ_BYTES), 2 ** 31 - 1))

    def show_chunks(self, older_than=None, newer_than=None, now: dt.datetime | None = None) -> DataFrame:
        """Chunks with their range, oldest first."""
        return show_chunks(self.spark.table(quoted(self.name)), self.time, self.width,
                           older_than, newer_than, now)

    # --- looking after chunks -----------------------------------------------------

    def chunks(self, older_than=None, newer_than=None, now: dt.datetime | None = None) -> list:
        """``(chunk start, partition path)`` of the chunks within the bounds, oldest first.

        The list comes from the catalog and has an entry per partition, not per row; only the
        partitions within the bounds reach the driver.
        """
        ctype = self._chunk_type()
        listed = self._partitions().select("partition", F.url_decode(F.regexp_extract(
            "partition", f"{CHUNK}=([^/]+)", 1)).cast(ctype).alias(CHUNK))
        keep = _bounds(self.width, age_bound(older_than, now), age_bound(newer_than, now), ctype)
        found = listed.filter(keep).orderBy(CHUNK, "partition").collect()
        return [(r[CHUNK], r["partition"]) for r in found]

    def _chunk_type(self) -> T.DataType:
        if self._kind is None:  # asked for every partition
            self._kind = self.spark.table(quoted(self.name)).schema[CHUNK].dataType
        return self._kind

    def _spec(self, path: str) -> str:
        """Full partition spec of a catalog entry such as ``chunk_start=…/dim_bucket=3``."""
        kind, out = self._chunk_type().simpleString(), []
        for part in path.split("/"):
            column, _, text = part.partition("=")
            value = unquote(text)
            if value == NULL_PARTITION:
                out.append(f"{column} = NULL")
            elif column == CHUNK:
                out.append(f"{column} = {kind} '{value}'")
            else:
                out.append(f"{column} = {int(value)}")
        return f"PARTITION ({', '.join(out)})"

    def drop_chunks(self, older_than=None, newer_than=None, now: dt.datetime | None = None,
                    dry_run: bool = False) -> list[dt.datetime]:
        """Drop whole chunks, irreversibly; returns their starts, oldest first."""
        if older_than is None and newer_than is None:
            raise ValueError("give older_than, newer_than or both")
        found = self.chunks(older_than, newer_than, now)
        if not dry_run:
            self.drop(found)
        return sorted({start for start, _ in found})

    def drop(self, chunks: list) -> None:
        """Drop partitions as listed by :meth:`chunks`, and their files.

        The table has a location of its own, so the catalog leaves the files alone; left in
        place, they would come back with the next row of the same chunk.
        """
        if not chunks:
            return
        self._forget([path for _, path in chunks], self._folders())
        self.spark.catalog.refreshTable(self.name)

    def replace(self, df: DataFrame, paths: Iterable[str], mark_compacted: bool = False) -> None:
        """As for all tables of partitions; ``mark_compacted`` notes what compaction wrote."""
        staged = self.stage(df)
        if mark_compacted:
            for path in staged.written:
                files, at = files_at(self.spark, staged.at(path))
                count = sum(_is_data(s) for s in files.listStatus(at))
                files.create(_child(self.spark, at, f"{COMPACTED}{count}"), True).close()
        self.swap(staged, paths)

    def is_compacted(self, path: str) -> bool:
        """Whether a partition is as the last compaction left it."""
        files, at = files_at(self.spark, self._folder(path))
        listed = [s for s in files.listStatus(at)] if files.exists(at) else []
        marks = [s.getPath().getName() for s in listed if s.getPath().getName().startswith(COMPACTED)]
        return marks == [f"{COMPACTED}{sum(_is_data(s) for s in listed)}"]

    def retain(self, drop_after: str, now: dt.datetime | None = None,
               dry_run: bool = False) -> list[dt.datetime]:
        """Drop chunks older than ``drop_after``; meant to be scheduled."""
        interval(drop_after)
        return self.drop_chunks(older_than=drop_after, now=now, dry_run=dry_run)

    def compact(self, segment_by: str | Iterable[str] = (), order_by: str | Iterable[str] = (),
                older_than=None, now: dt.datetime | None = None) -> list[dt.datetime]:
        """Rewrite old chunks sorted; returns the chunks rewritten.

        Sorting is what compresses: equal segments and near values end up side by side.
        The codec is the table's own (zstd).  A chunk that is as the last compaction left it is
        skipped; an insert, an upsert or new files make it eligible again.
        """
        held = self.chunks(older_than, None, now)
        due = sorted({start for start, path in held if not self.is_compacted(path)})
        kind = self._chunk_type()
        for at in range(0, len(due), SPECS_PER_STATEMENT):
            some = set(due[at:at + SPECS_PER_STATEMENT])
            table = self.spark.table(quoted(self.name))
            old = table.filter(F.col(CHUNK).isin([time_literal(s, kind) for s in some]))
            sorted_rows = compacted(old, names(segment_by), names(order_by) or [f"{self.time} DESC"])
            self.replace(sorted_rows.select(*table.columns), [p for s, p in held if s in some],
                         mark_compacted=True)
        return due

    def upsert(self, batch: DataFrame, keys: str | Iterable[str], **options) -> int:
        """Merge a batch whose key includes the time; only the touched chunks are rewritten.

        The time alone says which chunk a key is in, so the rows of a chunk are found whatever
        their dimension was, and a row whose dimension changes moves.  A chunk starts list of the
        batch is read first; an empty batch writes nothing.
        """
        keys = names(keys)
        if self.time not in keys:
            raise ValueError("the key of a chunked table must include its time column")
        placed = self._place(batch)
        parts, kind = self._partition_columns(placed), self._chunk_type()
        starts = {r[0] for r in placed.select(F.col(CHUNK).cast(kind)).distinct().collect()}
        if not starts:
            return 0
        table = self._table()
        # literal bounds prune the scan, whatever the size of the batch
        ranged = table.filter(F.col(CHUNK).between(time_literal(min(starts), kind), time_literal(max(starts), kind)))
        touched = self._gathered(ranged.filter(F.col(CHUNK).isin([time_literal(s, kind) for s in starts]))) \
            if len(starts) <= SPECS_PER_STATEMENT else ranged.join(placed.select(CHUNK).distinct(), CHUNK, "left_semi")
        paths = [path for start, path in self.chunks(None, min(starts)) if start in starts]
        merged = rows.upsert(touched.select(*table.columns), placed, keys, mark="_changed", **options)
        watch = Watch(merged, n=F.sum(F.col("_changed").cast("long")))
        self.replace(watch.df.drop("_changed").hint("rebalance", *[F.col(c) for c in parts]), paths)
        return watch.n


def _is_data(status) -> bool:
    return not status.getPath().getName().startswith(("_", "."))


def _child(spark: SparkSession, at, name: str):
    return spark._jvm.org.apache.hadoop.fs.Path(at, name)


def _sort_key(text: str) -> Column:
    parts = text.split()
    down = len(parts) == 2 and parts[1].upper() == "DESC"
    return F.col(parts[0]).desc_nulls_first() if down else F.col(parts[0]).asc_nulls_last()


def compacted(df: DataFrame, segment_by: list[str], order_by: list[str]) -> DataFrame:
    """Rows grouped by chunk and segment, each segment sorted.

    Range partitioning on chunk, segment and order cuts a hot chunk or segment into
    several sorted files; a last hash key cuts even rows that are equal in all of them.
    """
    keys = [F.col(CHUNK), *[F.col(c).asc_nulls_last() for c in segment_by],
            *[_sort_key(o) for o in order_by]]
    placed = df.withColumn("_spread", spread(df))
    return placed.repartitionByRange(*keys, "_spread").sortWithinPartitions(*keys).drop("_spread")


def show_chunks(df: DataFrame, time: str, width: str | Interval, older_than=None,
                newer_than=None, now: dt.datetime | None = None) -> DataFrame:
    """One row per chunk: its range, rows and first and last time, oldest first.

    For a chunked table the bounds on ``chunk_start`` prune partitions.
    """
    w = interval(width)
    if CHUNK not in df.columns:
        df = with_chunk(df, time, w)
    ctype = df.schema[CHUNK].dataType
    kept = df.filter(_bounds(w, age_bound(older_than, now), age_bound(newer_than, now), ctype))
    unit = ("MONTH", w.months) if w.is_calendar else ("MICROSECOND", w.micros)
    end = F.timestamp_add(unit[0], F.lit(unit[1]).cast("long"), F.col(CHUNK))
    return kept.groupBy(F.col(CHUNK).alias("range_start"), end.alias("range_end")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.min(time).alias("first_time"),
        F.max(time).alias("last_time")).orderBy("range_start")
