"""Interval text such as ``"5 minutes"`` as a fixed length or a number of months."""

from __future__ import annotations

import datetime as dt
import re
from dataclasses import dataclass

# Accepted units.
_UNIT_MICROS = {
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
    "week": 604_800_000_000,
}
_UNIT_MONTHS = {"month": 1, "year": 12}
_PATTERN = re.compile(rf"^(\d+)\s+({'|'.join([*_UNIT_MICROS, *_UNIT_MONTHS])})s?$", re.IGNORECASE)


@dataclass(frozen=True)
class Interval:
    """Either ``micros`` or ``months`` is non-zero, never both."""

    micros: int = 0
    months: int = 0

    @property
    def is_calendar(self) -> bool:
        return self.months > 0

    def before(self, moment: dt.datetime) -> dt.datetime:
        """``moment`` moved back by this interval (day clipped to the month's end)."""
        if not self.is_calendar:
            return moment - dt.timedelta(microseconds=self.micros)
        month_no = moment.year * 12 + moment.month - 1 - self.months
        year, month = divmod(month_no, 12)
        following = dt.date(year + (month == 11), (month + 1) % 12 + 1, 1)
        last_day = (following - dt.timedelta(days=1)).day
        return moment.replace(year=year, month=month + 1, day=min(moment.day, last_day))


def interval(value: str | dt.timedelta | Interval) -> Interval:
    """Parse an interval; raises ``ValueError`` on anything else, or on zero."""
    if isinstance(value, Interval):
        return value
    if isinstance(value, dt.timedelta):
        parsed = Interval(micros=value // dt.timedelta(microseconds=1))
    else:
        match = _PATTERN.match(str(value).strip())
        if match is None:
            raise ValueError(f"not an interval: {value!r}")
        count, unit = int(match.group(1)), match.group(2).lower()
        if unit in _UNIT_MONTHS:
            parsed = Interval(months=count * _UNIT_MONTHS[unit])
        else:
            parsed = Interval(micros=count * _UNIT_MICROS[unit])
    if parsed.micros <= 0 and parsed.months <= 0:
        raise ValueError(f"interval must be positive: {value!r}")
    return parsed
