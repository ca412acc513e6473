"""Time buckets, gap filling, last rows and moving windows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.intervals import Interval, interval
from tidemark.functions.timebucket import (
    bucket_index,
    bucket_start,
    index_of,
    micros_of,
    naive_utc,
    start_of,
    time_literal,
)
from tidemark.operators._columns import as_column, hashable, named, names, require_columns
from tidemark.operators.filters import raw_predicate

# Neighbours are looked up in slices of this many buckets, so that no task has to hold the
# whole bucket series of one key.
SLICE_BUCKETS = 65_536
# Rows of a spine are produced in blocks of this many, never as one long array.
BLOCK = 4_096
# Rows of a part of a moving frame, about.
ROWS_PER_PART = 100_000


def time_range(
    df: DataFrame,
    time: str,
    start: dt.datetime | None = None,
    finish: dt.datetime | None = None,
    chunk: tuple[str, str] | None = None,
) -> DataFrame:
    """Rows with ``start <= time < finish``.

    ``chunk=(column, interval)`` adds the bound that the range implies on the chunk
    column of a chunked table, so that whole partitions are skipped.
    """
    dtype = df.schema[time].dataType
    keep = F.lit(True)
    if start is not None:
        keep = keep & (F.col(time) >= time_literal(start, dtype))
    if finish is not None:
        keep = keep & (F.col(time) < time_literal(finish, dtype))
    if chunk is not None:
        column, width = chunk
        ctype = df.schema[column].dataType
        if start is not None:
            first = start_of(index_of(start, width), width)
            keep = keep & (F.col(column) >= time_literal(first, ctype))
        if finish is not None:
            keep = keep & (F.col(column) < time_literal(finish, ctype))
    return df.filter(keep)


def time_bucket_agg(
    df: DataFrame,
    time: str,
    width: str | Interval,
    aggregates: Mapping[str, Column | str],
    by: str | Iterable[str] = (),
    where: Column | str | None = None,
    ordered: bool = False,
) -> DataFrame:
    """Aggregates per time bucket (and per ``by`` columns); output column ``bucket``.

    One shuffle, of partial aggregates only: a key that holds most of the rows sends at
    most one row per task and bucket.
    """
    by = names(by)
    require_columns(df, [time, *by])
    dtype = df.schema[time].dataType
    grouped = (
        raw_predicate(df, where)
        .groupBy(bucket_index(F.col(time), width).alias("_index"), *by)
        .agg(*named(aggregates))
    )
    out = grouped.select(
        bucket_start(F.col("_index"), width, dtype).alias("bucket"), *by, *aggregates
    )
    return out.orderBy("bucket", *by) if ordered else out


def _neighbours(buckets: DataFrame, by: list[str], carry: list[str], values: list[str]) -> DataFrame:
    """Add ``_next`` (struct of the next bucket), ``_first`` and carried values.

    ``carry`` columns are replaced by their last non-NULL value up to the row.
    """
    following = F.struct("_index", *values)
    cut = buckets.withColumn("_slice", F.floor(F.col("_index") / SLICE_BUCKETS))
    series = Window.partitionBy(*by, "_slice").orderBy("_index")
    so_far = series.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inner = cut.withColumns({
        "_next": F.lead(following).over(series),
        "_first": F.lag("_index").over(series).isNull(),
    }).withColumns({c: F.last(c, ignorenulls=True).over(so_far) for c in carry})

    # one row per slice: its first bucket and the last non-NULL values inside it
    edges = cut.groupBy(*by, "_slice").agg(
        F.min_by(following, "_index").alias("_head"),
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("_index"))).alias(f"_tail_{c}")
          for c in carry],
    )
    over_slices = Window.partitionBy(*by).orderBy("_slice")
    earlier = over_slices.rowsBetween(Window.unboundedPreceding, -1)
    edges = edges.select(
        *[F.col(c).alias(f"_by_{c}") for c in by],
        F.col("_slice").alias("_by__slice"),
        F.lead("_head").over(over_slices).alias("_next_head"),
        F.lag("_slice").over(over_slices).isNull().alias("_no_slice_before"),
        *[F.last(f"_tail_{c}", ignorenulls=True).over(earlier).alias(f"_before_{c}")
          for c in carry],
    )
    on = F.lit(True)
    for c in [*by, "_slice"]:
        on = on & F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    joined = inner.join(edges, on, "inner")
    return joined.withColumns({
        "_next": F.coalesce("_next", "_next_head"),
        "_first": F.col("_first") & F.col("_no_slice_before"),
        **{c: F.coalesce(c, f"_before_{c}") for c in carry},
    })


def gapfill(
    df: DataFrame,
    time: str,
    width: str | Interval,
    start: dt.datetime,
    finish: dt.datetime,
    aggregates: Mapping[str, Column | str],
    by: str | Iterable[str] = (),
    where: Column | str | None = None,
    locf: Iterable[str] = (),
    interpolate: Iterable[str] = (),
    treat_null_as_missing: bool = False,
    ordered: bool = False,
) -> DataFrame:
    """Aggregates per time bucket with every bucket of ``[start, finish)`` present.

    Missing buckets are NULL, the last bucket's value (``locf``) or the linear value
    between the neighbouring buckets (``interpolate``).  With ``by``, every key found in
    the range gets its full series.

    The rows are first aggregated; each existing bucket then emits the gap that follows
    it.  There is no spine to join with, so the cost is one shuffle of partial
    aggregates, one window over buckets and the output itself.
    """
    if start is None or finish is None:
        raise ValueError("start and finish are required")
    if naive_utc(start) >= naive_utc(finish):
        raise ValueError("start must be before finish")
    by, locf, interpolate = names(by), names(locf), names(interpolate)
    unknown = (set(locf) | set(interpolate)) - set(aggregates)
    if unknown or set(locf) & set(interpolate):
        raise ValueError("locf and interpolate take distinct aggregate names")
    require_columns(df, [time, *by])

    w = interval(width)
    first = index_of(start, w)
    stop = index_of(naive_utc(finish) - dt.timedelta(microseconds=1), w) + 1
    dtype = df.schema[time].dataType

    rows = raw_predicate(time_range(df, time, start, finish), where)
    buckets = rows.groupBy(bucket_index(F.col(time), w).alias("_index"), *by).agg(
        *named(aggregates)
    )
    if not by:
        # without keys the series exists even when no row does
        marker = df.sparkSession.range(1).select(
            F.lit(None).cast("long").alias("_index"),
            *[F.lit(None).cast(buckets.schema[a].dataType).alias(a) for a in aggregates],
        )
        buckets = buckets.unionByName(marker)
    carry = locf if treat_null_as_missing else []
    values = list(aggregates)
    if not by:
        # the marker sorts first and stands for the bucket before the range
        buckets = buckets.withColumn("_index", F.coalesce("_index", F.lit(first - 1).cast("long")))
    filled = _neighbours(buckets, by, carry, values)

    index, following = F.col("_index"), F.col("_next")
    low = F.when(F.col("_first"), F.lit(first).cast("long")).otherwise(index)
    high = F.coalesce(following["_index"], F.lit(stop).cast("long")) - 1
    spread_out = (
        filled.withColumns({"_low": low, "_high": high})
        .filter(F.col("_high") >= F.col("_low"))
        .withColumn("_block", F.explode(F.sequence("_low", "_high", F.lit(BLOCK).cast("long"))))
        .withColumn("_at", F.explode(F.sequence(
            "_block", F.least(F.col("_block") + (BLOCK - 1), F.col("_high")))))
    )
    at = F.col("_at")
    out = []
    for name in values:
        own, dtype_of = F.col(name), buckets.schema[name].dataType
        value = F.when(at == index, own)
        if name in locf:
            value = F.when(at >= index, own)
        elif name in interpolate:
            value = value.when(
                (at > index) & following.isNotNull(),
                _between(at, index, following["_index"], own, following[name], dtype_of),
            )
        out.append(value.alias(name))
    result = spread_out.filter(at >= F.lit(first).cast("long")).select(
        bucket_start(at, w, dtype).alias("bucket"), *by, *out
    )
    return result.orderBy("bucket", *by) if ordered else result


def _between(x: Column, x0: Column, x1: Column, y0: Column, y1: Column, dtype: T.DataType) -> Column:
    """Value at ``x`` on the line through two buckets; whole numbers stay whole."""
    weighted = y0 * (x1 - x) + y1 * (x - x0)
    if isinstance(dtype, T.IntegralType):
        return F.call_function("div", weighted, x1 - x0).cast(dtype)
    return (weighted / (x1 - x0)).cast(dtype)


def last_per_key(
    df: DataFrame,
    keys: str | Iterable[str],
    time: str,
    tie_break: str | Iterable[str] = (),
    columns: Iterable[str] | None = None,
) -> DataFrame:
    """The newest row of every key (a NULL time counts as newest).

    Of several, ``tie_break`` decides, then the other columns, so the choice is repeatable.  An aggregate rather than a window: each task first reduces its own rows to one per
    key, so a hot key costs one row per task in the shuffle.
    """
    keys, tie_break = names(keys), names(tie_break)
    payload = [c for c in (columns or df.columns) if c not in keys]
    rank = F.struct(F.col(time).isNull(), F.col(time), *[F.col(c) for c in tie_break],
                    *hashable(df, [c for c in df.columns if c not in keys]))
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*payload), rank).alias("_row"))
    return best.select(*keys, *[F.col("_row")[c].alias(c) for c in payload])


def moving_window(
    df: DataFrame,
    time: str,
    frame: str | Interval,
    aggregates: Mapping[str, Column | str],
    by: str | Iterable[str] = (),
) -> DataFrame:
    """Aggregates over the rows of the last ``frame`` up to each row's time (inclusive).

    Any aggregate will do, so the rows themselves have to meet: a key's series is cut into slices of
    one frame, each preceded by a copy of the slice before it.  For counts, sums and extremes of a
    dense series :func:`moving_measures` needs far less.
    """
    w = interval(frame)
    if w.is_calendar:
        raise ValueError("a moving window needs a fixed-length frame")
    by = names(by)
    require_columns(df, [time, *by])
    placed = _in_two_parts(df, time, w.micros, 1)
    window = (
        Window.partitionBy(*by, "_part").orderBy("_us").rangeBetween(-w.micros, Window.currentRow)
    )
    return placed.withColumns(
        {name: as_column(expr).over(window) for name, expr in aggregates.items()}
    ).filter("_own").select(*df.columns, *aggregates)


def _in_two_parts(df: DataFrame, time: str, length: int, parts: int) -> DataFrame:
    """Each row in its own part of ``length`` microseconds, and in the one that is ``parts`` later."""
    home = F.floor(F.col("_us") / F.lit(length).cast("long"))
    copies = F.array(F.struct(home.alias("part"), F.lit(True).alias("own")),
                     F.struct((home + parts).alias("part"), F.lit(False).alias("own")))
    placed = df.withColumn("_us", micros_of(F.col(time))).withColumn("_copy", F.explode(copies))
    placed = placed.filter("_copy.own OR _copy.part IS NOT NULL")  # rows without a time once
    return placed.select(*df.columns, "_us", F.col("_copy.part").alias("_part"), F.col("_copy.own").alias("_own"))


# How a measure is taken of rows, and how two of them combine.
MEASURES = {"count": (F.count, F.sum), "sum": (F.sum, F.sum), "min": (F.min, F.min), "max": (F.max, F.max)}


def moving_measures(
    df: DataFrame,
    time: str,
    frame: str | Interval,
    measures: Mapping[str, tuple[str, Column | str]],
    by: str | Iterable[str] = (),
    rows_per_part: int = ROWS_PER_PART,
) -> DataFrame:
    """Counts, sums and extremes over the last ``frame`` up to each row's time (inclusive).

    ``measures`` maps a name to ``(count | sum | min | max, column)``.  A frame is cut into equal
    parts, so short that the densest holds about ``rows_per_part`` rows.  Parts that lie whole inside
    a row's frame count by their aggregates; only the rows of the two parts at its ends meet: from the
    start of the later part up to the row, and from the row's time less the frame to the end of the
    earlier part.  Both are running aggregates, from either side, so a row costs the same however many
    rows its frame holds, and no value is ever taken away from a sum.  The work spreads with the rows,
    also for one key, and every row is copied once.  Rows without a time are a frame of their own.
    """
    w = interval(frame)
    if w.is_calendar:
        raise ValueError("a moving window needs a fixed-length frame")
    by = names(by)
    require_columns(df, [time, *by])
    unknown = {kind for kind, _ in measures.values()} - set(MEASURES)
    if unknown or not measures:
        raise ValueError(f"a measure is one of {', '.join(MEASURES)}")
    columns = {name: as_column(c) for name, (_, c) in measures.items()}
    kinds = {name: MEASURES[kind] for name, (kind, _) in measures.items()}
    densest = df.groupBy(*by, F.floor(micros_of(F.col(time)) / F.lit(w.micros))).count().agg(
        F.max("count")).first()[0] or 1
    parts = max(1, -(-densest // rows_per_part))
    while w.micros % parts:  # parts of a whole number of microseconds
        parts += 1
    length = w.micros // parts

    placed = _in_two_parts(df.withColumns({f"_m_{n}": c for n, c in columns.items()}), time, length, parts)
    # the earlier part moved on by the frame: what is not before a row then lies inside its frame
    placed = placed.withColumn("_at", F.when(F.col("_own"), F.col("_us")).otherwise(F.col("_us") + w.micros))
    running = Window.partitionBy(*by, "_part").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    up, down = running.orderBy(F.col("_at").asc()), running.orderBy(F.col("_at").desc())

    def joined(name, one, other):
        kind = measures[name][0]
        if kind == "min":
            return F.least(one, other)
        if kind == "max":
            return F.greatest(one, other)
        # a sum over no values is NULL
        return F.coalesce(one + other, one, other)

    near = placed.withColumns({
        f"_{side}_{n}": take(F.when(mine, F.col(f"_m_{n}"))).over(window) for n, (take, _) in kinds.items()
        for side, window, mine in (("up", up, F.col("_own")), ("down", down, ~F.col("_own")))}).filter("_own")
    near = near.withColumns({f"_e_{n}": joined(n, F.col(f"_up_{n}"), F.col(f"_down_{n}")) for n in measures})
    if parts == 1:
        return near.select(*[F.col(f"`{c}`") for c in df.columns],
                           *[F.col(f"_e_{n}").alias(n) for n in measures])
    whole = placed.filter("_own AND _part IS NOT NULL").groupBy(*by, "_part").agg(
        *[take(F.col(f"_m_{n}")).alias(f"_m_{n}") for n, (take, _) in kinds.items()])
    # the parts between the two ends, for every part that has rows
    between = Window.partitionBy(*by).orderBy("_part").rangeBetween(1 - parts, -1)
    inner = whole.select(*[F.col(c).alias(f"_by_{c}") for c in by], F.col("_part").alias("_by__part"), *[
        combine(F.col(f"_m_{n}")).over(between).alias(f"_w_{n}") for n, (_, combine) in kinds.items()])
    on = F.lit(True)
    for c in [*by, "_part"]:
        on = on & F.col(c).eqNullSafe(F.col(f"_by_{c}"))

    return near.join(inner, on, "left").select(
        *[F.col(f"`{c}`") for c in df.columns], *[joined(n, F.col(f"_e_{n}"), F.col(f"_w_{n}")).alias(n) for n in measures])
