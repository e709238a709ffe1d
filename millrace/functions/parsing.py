"""Dirty text to numbers under ANSI mode: a value that does not parse is NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The formats a day may come in.
DAY_FORMATS = ("yyyy-MM-dd HH:mm:ss", "yyyy/MM/dd HH:mm:ss", "yyyy-MM-dd", "yyyy/MM/dd")

# What a human writes around a number, and what a plain number looks like.
MONEY_NOISE = r"[$,\s]"
MONEY_MARKS = "$, \t\r\n\f\u000b"
PLAIN_NUMBER = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)$"
WHOLE_NUMBER = r"^[+-]?[0-9]+(\.0*)?$"
MONEY_MASKS = tuple(f"S{sign}{'9' * 28}.{'9' * 10}" for sign in ("$", ""))


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_money(c: str | Column, route: str = "cast") -> Column:
    """Amount as double.

    ``cast``   strip noise, then ``try_cast``: also takes what Spark calls a double (``1e3``, ``NaN``).
    ``regex``  the same behind a plain-number gate, so exponents and ``NaN`` are rejected.
    ``mask``   number masks, as wide as a decimal can be; takes what ``regex`` takes, and what is wider than
               28 whole or 10 decimal digits goes through the gate of ``regex``.
    """
    if route == "cast":
        return F.regexp_replace(_col(c), MONEY_NOISE, "").try_cast("double")
    if route == "regex":
        bare = F.translate(_col(c), MONEY_MARKS, "")
        return F.when(bare.rlike(PLAIN_NUMBER), bare.try_cast("double"))
    if route == "mask":
        text = F.translate(_col(c), MONEY_MARKS.replace("$", ""), "")
        parsed = [F.try_to_number(text, F.lit(mask)).cast("double") for mask in MONEY_MASKS]
        return F.coalesce(*parsed, parse_money(c, "regex"))
    raise ValueError(f"unknown route {route!r}")


def parse_count(c: str | Column) -> Column:
    """Whole count as int: ``5`` and ``12.0`` are counts, ``2.5``, text and overflow are NULL."""
    text = F.trim(_col(c))
    return F.when(text.rlike(WHOLE_NUMBER), text.try_cast("double").try_cast("int"))


def parse_day(c: str | Column, formats: tuple[str, ...] = DAY_FORMATS) -> Column:
    """Date from the first format that fits."""
    text = _col(c)
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in formats]).cast("date")
