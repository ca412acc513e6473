"""Stream-fed tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.intervals import interval
from tidemark.functions.timebucket import FIXED_ORIGIN, epoch_micros, index_of, start_of, time_bucket
from tidemark.operators._columns import named, names
from tidemark.operators.timeseries import time_bucket_agg
from tidemark.sources.chunks import ChunkedTable
from tidemark.sources.tables import Tables


def windowed(stream: DataFrame, time: str, width: str, aggregates: Mapping[str, Column | str],
             by: str | Iterable[str] = (), lateness: str = "0 seconds") -> DataFrame:
    """Bucketed aggregate of a stream, with the same buckets as the batch operator.

    State for a bucket is dropped once the event time has passed its end by ``lateness``.
    """
    w, by = interval(width), names(by)
    if w.is_calendar:
        raise ValueError("a streaming bucket needs a fixed length")
    start = epoch_micros(FIXED_ORIGIN) % w.micros
    length = f"{w.micros} microseconds"
    bucket = F.window(F.col(time), length, length, f"{start} microseconds")
    return stream.withWatermark(time, lateness).groupBy(bucket.alias("_window"), *by).agg(
        *named(aggregates)).select(F.col("_window.start").alias("bucket"), *by, *aggregates)


def maintain_aggregate(stream: DataFrame, table: ChunkedTable, time: str, width: str,
                       aggregates: Mapping[str, Column | str], checkpoint: str,
                       by: str | Iterable[str] = (), lateness: str = "0 seconds") -> StreamingQuery:
    """Keep a bucket table up to date from a stream.

    Every batch carries the whole new value of each changed bucket and replaces it, so a
    batch that runs twice changes nothing.  NULL is a group like any other.  Only the touched
    chunks are rewritten.
    """
    by = names(by)
    buckets = windowed(stream, time, width, aggregates, by, lateness)

    def each(batch: DataFrame, batch_id: int) -> None:
        # the upsert reads the batch more than once; do not aggregate it again
        batch.persist()
        try:
            table.upsert(batch, ["bucket", *by], match_nulls=True)
        finally:
            batch.unpersist()

    return buckets.writeStream.outputMode("update").foreachBatch(each).option(
        "checkpointLocation", checkpoint).trigger(availableNow=True).start()


def maintain_recomputed(stream: DataFrame, rows: ChunkedTable, keys: str | Iterable[str], buckets: ChunkedTable,
                        width: str, aggregates: Mapping[str, Column | str], checkpoint: str,
                        by: str | Iterable[str] = ()) -> StreamingQuery:
    """Keep a bucket table up to date however late its rows come.

    No state is held, so none expires: a batch is merged into the chunked table ``rows`` by time and ``keys``, and
    the buckets it touches are computed anew from there, reading the chunks between the first and the last of
    them.  A batch that runs twice, or an event that comes twice, changes nothing.  Rows without a
    time belong to no bucket and are left out; the rows of a key stay in their group.  Buckets may be months.
    """
    by, keys = names(by), names(keys)
    time, w = rows.time, interval(width)

    def each(batch: DataFrame, batch_id: int) -> None:
        timed = batch.filter(F.col(time).isNotNull()).dropDuplicates([time, *keys]).persist()
        try:
            rows.upsert(timed, [time, *keys], match_nulls=True)
            touched = timed.select(time_bucket(F.col(time), w).alias("_bucket"),
                                   *[F.col(c).alias(f"_by_{c}") for c in by]).distinct()
            low, high = touched.agg(*[f("_bucket").cast("timestamp_ntz") for f in (F.min, F.max)]).first()
            if low is None:
                return
            near = rows.read(low, start_of(index_of(high, w) + 1, w))
            same = reduce(lambda a, c: a & F.col(c).eqNullSafe(F.col(f"_by_{c}")), by,
                          time_bucket(F.col(time), w) == F.col("_bucket"))
            fresh = time_bucket_agg(near.join(touched, same, "left_semi"), time, width, aggregates, by)
            buckets.upsert(fresh, ["bucket", *by], match_nulls=True)
        finally:
            timed.unpersist()

    return stream.writeStream.foreachBatch(each).option(
        "checkpointLocation", checkpoint).trigger(availableNow=True).start()


def maintain_rows(stream: DataFrame, tables: Tables, target: str, keys: str | Iterable[str],
                  order_by: str | Iterable[str], checkpoint: str) -> StreamingQuery:
    """Keep the newest row of each key, by ``order_by``, in a table.

    A stored row only gives way to a newer one, so neither the order of arrival nor a
    batch that runs twice changes the result.  NULL is a key like any other.  The checkpoint
    takes the place of a high-water mark.  Of a keyed table only the segments of the batch are
    read and rewritten.
    """
    keys, order_by = names(keys), names(order_by)

    def each(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            known = tables.near(batch, target, keys)
            mine = batch.select(*[F.col(k).alias(f"_k_{k}") for k in keys]).distinct()
            same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys])
            rivals = known.join(mine, same, "left_semi")
            newest = batch.select(*known.columns).unionByName(rivals.select(*known.columns))
            tables.upsert(newest, target, keys, on_duplicate="last", order_by=order_by, match_nulls=True)
        finally:
            batch.unpersist()

    return stream.writeStream.foreachBatch(each).option(
        "checkpointLocation", checkpoint).trigger(availableNow=True).start()


def as_event_time(df: DataFrame, time: str) -> DataFrame:
    """Event time as an instant, which stream watermarks need."""
    if isinstance(df.schema[time].dataType, T.TimestampType):
        return df
    return df.withColumn(time, F.col(time).cast("timestamp"))
