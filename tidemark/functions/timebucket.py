"""Time buckets as plain column arithmetic.

A bucket has an integer index: microseconds (or months) since the origin, divided by
the width.  Grouping and gap filling work on the index, which stays inside code
generation; timestamps are derived from it at the edge.  Instants are read in the
session time zone, which :func:`tidemark.session.prepare` pins to UTC.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.intervals import Interval, interval

EPOCH = dt.datetime(1970, 1, 1)
# Fixed-length buckets count from a Monday, calendar buckets from a January.
FIXED_ORIGIN = dt.datetime(2000, 1, 3)
MONTH_ORIGIN = dt.datetime(2000, 1, 1)


def naive_utc(moment: dt.datetime | dt.date) -> dt.datetime:
    """A datetime in UTC without zone."""
    if not isinstance(moment, dt.datetime):
        return dt.datetime(moment.year, moment.month, moment.day)
    if moment.tzinfo is not None:
        return moment.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return moment


def epoch_micros(moment: dt.datetime | dt.date) -> int:
    return (naive_utc(moment) - EPOCH) // dt.timedelta(microseconds=1)


def time_literal(moment: dt.datetime | dt.date, dtype: T.DataType) -> Column:
    """A literal of the time column's own type, so that the filter reaches the scan."""
    text = naive_utc(moment).isoformat(sep=" ")
    return F.lit(text).cast(dtype)


def micros_of(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def _months_of(ts: Column) -> Column:
    return (F.year(ts) * 12 + F.month(ts) - 1).cast("long")


def _origin_micros(origin: dt.datetime | None) -> int:
    return epoch_micros(origin or FIXED_ORIGIN)


def _origin_months(origin: dt.datetime | None) -> int:
    start = origin or MONTH_ORIGIN
    return start.year * 12 + start.month - 1


def bucket_index(ts: Column, width: str | Interval, origin: dt.datetime | None = None) -> Column:
    """Index of the bucket that holds ``ts`` (long; NULL for a NULL time)."""
    w = interval(width)
    if w.is_calendar:
        offset, size = _months_of(ts) - F.lit(_origin_months(origin)), w.months
    else:
        offset, size = micros_of(ts) - F.lit(_origin_micros(origin)), w.micros
    return _floor_div(offset, size)


def _floor_div(value: Column, size: int) -> Column:
    # integer arithmetic only: doubles lose microseconds
    size_lit = F.lit(size).cast("long")
    return F.call_function("div", value - F.pmod(value, size_lit), size_lit)


def bucket_start(
    index: Column, width: str | Interval, dtype: T.DataType, origin: dt.datetime | None = None
) -> Column:
    """Start of the bucket with the given index, as ``dtype``."""
    w = interval(width)
    if w.is_calendar:
        month_no = index * F.lit(w.months).cast("long") + F.lit(_origin_months(origin))
        start = F.make_date(
            _floor_div(month_no, 12).cast("int"),
            (F.pmod(month_no, F.lit(12).cast("long")) + 1).cast("int"),
            F.lit(1),
        )
        return start.cast(dtype)
    micros = index * F.lit(w.micros).cast("long") + F.lit(_origin_micros(origin))
    return F.timestamp_micros(micros).cast(dtype)


def time_bucket(ts: Column, width: str | Interval, origin: dt.datetime | None = None) -> Column:
    """Start of the bucket that holds ``ts``, in the type of ``ts``."""
    w = interval(width)
    if w.is_calendar:
        stamp = ts.cast("timestamp")
        into_month = F.unix_micros(stamp) - F.unix_micros(F.date_trunc("month", stamp))
        month_start = F.timestamp_add("MICROSECOND", -into_month, ts)
        behind = F.pmod(_months_of(ts) - F.lit(_origin_months(origin)), F.lit(w.months).cast("long"))
        return F.timestamp_add("MONTH", -behind, month_start)
    behind = F.pmod(micros_of(ts) - F.lit(_origin_micros(origin)), F.lit(w.micros).cast("long"))
    return F.timestamp_add("MICROSECOND", -behind, ts)


def index_of(moment: dt.datetime, width: str | Interval, origin: dt.datetime | None = None) -> int:
    """Driver-side twin of :func:`bucket_index` for literal bounds."""
    w, moment = interval(width), naive_utc(moment)
    if w.is_calendar:
        return (moment.year * 12 + moment.month - 1 - _origin_months(origin)) // w.months
    return (epoch_micros(moment) - _origin_micros(origin)) // w.micros


def start_of(index: int, width: str | Interval, origin: dt.datetime | None = None) -> dt.datetime:
    """Driver-side twin of :func:`bucket_start`."""
    w = interval(width)
    if w.is_calendar:
        year, month = divmod(index * w.months + _origin_months(origin), 12)
        return dt.datetime(year, month + 1, 1)
    return EPOCH + dt.timedelta(microseconds=index * w.micros + _origin_micros(origin))
