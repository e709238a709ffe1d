"""Conditional, interval and money expressions."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from .timing import whole_div


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


#: What a double may be off a decimal, as a part of the value: a few units in its last place, and never more.
NOISE = 2.0**-50


def minor(c: str | Column, scale: int = 2) -> Column:
    """A value in whole units of its last decimal (cents for scale 2), for integer arithmetic and window sums.

    ``scale`` declares how many decimals the values have.  One that has more, or is no number, is an error,
    never rounded away; what a double cannot hold of a decimal is not taken for a digit.  Integers add up
    the same in any order, and a total over 9.2e18 units is an error under ANSI.
    """
    scaled = _col(c) * F.lit(float(10**scale))
    unit = F.rint(scaled)
    noise = F.abs(scaled) * F.lit(NOISE)
    text = F.concat(F.lit(f"more than {scale} decimals: "), _col(c).cast("string"))
    return F.when(scaled.isNull() | (F.abs(scaled - unit) <= noise), unit.cast("bigint")).otherwise(
        F.raise_error(text).cast("bigint")
    )


def major(units: Column, scale: int = 2) -> Column:
    """Minor units back as double."""
    return units / F.lit(float(10**scale))


#: Decimals a summed value may have unless the caller declares more; a finer value is an error.
SUM_SCALE = 6


def _finite(value: Column) -> Column:
    return F.abs(value.cast("double")) < F.lit(float("inf"))


def sum_parts(c: str | Column, scale: int = SUM_SCALE) -> tuple[Column, Column]:
    """Two integer aggregates: whole units, and units of the last decimal of what is left over.

    They are as fast as a sum of doubles and several times faster than a sum of decimals, do not depend
    on the order of the rows, and neither can overflow on any real table.  NaN and infinities are left
    out of both (see ``odd_part``).
    """
    value = F.when(_finite(_col(c)), _col(c))
    # Cut towards zero: what is left over is exact, also of a small negative value.
    whole = F.when(value < 0, F.ceil(value)).otherwise(F.floor(value))
    scaled = (value - whole) * F.lit(float(10**scale))
    unit = F.rint(scaled)
    noise = F.abs(value) * F.lit(NOISE * 10**scale)
    text = F.concat(F.lit(f"more than {scale} decimals: "), _col(c).cast("string"))
    part = F.when(scaled.isNull() | (F.abs(scaled - unit) <= noise), unit.cast("bigint")).otherwise(
        F.raise_error(text).cast("bigint")
    )
    return F.sum(whole), F.sum(part)


def odd_part(c: str | Column) -> Column:
    """Sum of the values that are no finite numbers; NULL without any.  Its result does not depend on the order."""
    return F.sum(F.when(~_finite(_col(c)), _col(c).cast("double")))


def join_parts(whole: Column, units: Column, scale: int = SUM_SCALE) -> Column:
    """The decimal that ``sum_parts`` took apart."""
    return whole.cast("decimal(20,0)") + units.cast("decimal(20,0)") * F.lit(Decimal(1).scaleb(-scale))


def exact_parts(c: str | Column, scale: int = SUM_SCALE) -> list[Column]:
    """The three aggregates that an exact sum consists of; sums of them over groups are those of all rows."""
    return [*sum_parts(c, scale), odd_part(c)]


def exact_value(whole: Column, units: Column, odd: Column, scale: int = SUM_SCALE, digits: int | None = None, over: Column | None = None) -> Column:
    """What ``exact_sum`` makes of its parts, or ``exact_avg`` with a count to divide them by."""
    total = join_parts(whole, units, scale)
    total = total if over is None else total / over
    return F.coalesce(odd, (total if digits is None else F.round(total, digits)).cast("double"))


def exact_total(c: str | Column, scale: int = SUM_SCALE) -> Column:
    """Sum of finite doubles of at most ``scale`` decimals as a decimal, exact in any row order; any other value is
    an error."""
    odd = F.raise_error(F.lit("not a finite number")).cast("decimal(20,0)")
    return F.when(odd_part(c).isNull(), join_parts(*sum_parts(c, scale), scale)).otherwise(odd)


def exact_sum(c: str | Column, digits: int | None = None, scale: int = SUM_SCALE) -> Column:
    """The exact sum as double, rounded half up if ``digits`` is given; NaN if any value is."""
    return exact_value(*exact_parts(c, scale), scale=scale, digits=digits)


def exact_avg(c: str | Column, digits: int = 2, scale: int = SUM_SCALE) -> Column:
    """Average rounded half up, the same in any row order; NaN if any value is."""
    return exact_value(*exact_parts(c, scale), scale=scale, digits=digits, over=F.count(_col(c)))


def bucketize(c: str | Column, edges: Sequence, labels: Sequence[str]) -> Column:
    """Label of the half-open range ``[edge[i-1], edge[i])``; NULL stays NULL."""
    if len(labels) != len(edges) + 1:
        raise ValueError("one more label than edges")
    value = _col(c)
    out = F.when(value.isNull(), F.lit(None))
    for edge, label in zip(edges, labels):
        out = out.when(value < F.lit(edge), F.lit(label))
    return out.otherwise(F.lit(labels[-1]))


def in_interval(at: Column, lo: Column, hi: Column) -> Column:
    """``lo <= at < hi`` where a NULL ``hi`` means still open."""
    return (lo <= at) & (hi.isNull() | (at < hi))


def between_days(day: Column, first: Column, last: Column) -> Column:
    """Both ends belong to the window."""
    return (day >= first) & (day <= last)


def net_of_pct(amount: Column, pct: Column) -> Column:
    """Integer units left after taking ``pct`` percent, without a float in between."""
    return amount - whole_div(amount * pct, F.lit(100))


def pct_change(cur: Column, prev: Column, digits: int = 2) -> Column:
    """Signed growth in percent of the previous value; NULL when that is zero or unknown."""
    return F.when(prev != 0, F.round((cur - prev) * 100 / prev, digits))


def count_where(cond: Column) -> Column:
    return F.count_if(cond)


def any_of(c: str | Column, values: Sequence) -> Column:
    return _col(c).isin(*values)


def tidy_key(c: str | Column) -> Column:
    """Trimmed and upper-cased; NULL stays NULL."""
    return F.upper(F.trim(_col(c)))


def same_values(pairs: Sequence[tuple[Column, Column]]) -> Column:
    """True when every pair is equal, two NULLs counting as equal."""
    out = F.lit(True)
    for a, b in pairs:
        out = out & a.eqNullSafe(b)
    return out
