"""Exact time arithmetic on ``timestamp`` and ``timestamp_ntz`` columns."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def whole_div(a: Column, b: Column) -> Column:
    """Integer division, cut towards zero."""
    return F.call_function("div", a, b)


def width_us(width: timedelta) -> int:
    us = width // timedelta(microseconds=1)
    if us <= 0:
        raise ValueError("a width must be positive")
    return us


def epoch_us(at: str | Column) -> Column:
    """Microseconds since the epoch, exact and independent of DST; dates and ISO strings work too."""
    zero = F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00"))
    return F.timestamp_diff("MICROSECOND", zero, _col(at).cast("timestamp_ntz"))


def epoch_s(at: str | Column) -> Column:
    """Whole seconds since the epoch, rounded down also before 1970."""
    us = epoch_us(at)
    return whole_div(us - F.pmod(us, F.lit(1_000_000)), F.lit(1_000_000))


def cell_of(at: str | Column, width: timedelta) -> Column:
    """Start (epoch microseconds) of the fixed-width cell the instant lies in."""
    us = epoch_us(at)
    return us - F.pmod(us, F.lit(width_us(width)))


def seconds_between(start: str | Column, end: str | Column) -> Column:
    """Whole seconds from start to end, each end cut to its second first."""
    return epoch_s(end) - epoch_s(start)


def day_text(at: str | Column) -> Column:
    return F.date_format(_col(at), "yyyy-MM-dd")


def hour_text(at: str | Column) -> Column:
    """Hour bucket as ``yyyy-MM-dd HH:00:00``; ISO strings work as well as timestamps."""
    return F.concat(F.substring(_col(at).cast("string"), 1, 13), F.lit(":00:00"))


def stamp_text(at: str | Column) -> Column:
    return F.date_format(_col(at), "yyyy-MM-dd HH:mm:ss")


def local_time(at_utc: str | Column, zone: str | Column) -> Column:
    """Wall clock of each row's own zone for a UTC instant."""
    return F.from_utc_timestamp(_col(at_utc).cast("timestamp"), _col(zone))


def utc_of_local_midnight(day: str | Column, zone: str | Column, plus_days: int = 0) -> Column:
    """The UTC instant at which a local calendar day (shifted by whole days) begins."""
    return F.to_utc_timestamp(F.date_add(_col(day), plus_days).cast("timestamp"), _col(zone))
