"""Joins against validity intervals: half-open, a NULL end meaning still open."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.values import in_interval
from .dyadic import highest_cover
from .timeline import last_known, next_in_key, running_total


def close_intervals(
    dim: DataFrame,
    keys: Sequence[str],
    lo: str,
    hi: str,
    ties: Sequence[str] = (),
    width: timedelta | None = None,
) -> DataFrame:
    """End each assignment no later than the key's next one starts, so at most one covers any instant.

    Of several rows with the same start only the last by ``ties`` keeps a non-empty interval.  A key
    with very many assignments needs ``width``: its timeline is then cut into cells.
    """
    if width is None:
        order = W.partitionBy(*keys).orderBy(lo, *ties)
        return dim.withColumn(hi, F.least(F.col(hi), F.lead(lo).over(order)))
    near = next_in_key(dim, keys, lo, {lo: "_next_lo"}, ties, width)
    return near.withColumn(hi, F.least(hi, "_next_lo")).drop("_next_lo")


def interval_join(
    fact: DataFrame,
    dim: DataFrame,
    keys: Sequence[str],
    at: str,
    lo: str,
    hi: str,
    take: Mapping[str, object],
    resolve: str = "repair",
    fact_key: Sequence[str] = (),
    ties: Sequence[str] = (),
    width: timedelta = timedelta(days=30),
    direct: bool = False,
    max_rows: int | None = None,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Attributes in effect at the fact's own time; ``take`` maps attribute -> default (None: NULL).

    ``repair``  an interval ends where the key's next one starts, so at most one covers a fact.
    ``rank``    of the intervals that cover the fact, the latest start wins.  An older interval shows again once a
                newer one has ended, which ``repair`` rules out.  The direct form needs the unique ``fact_key``.

    Of equal starts the first by ``ties``, smallest first and NULL last, counts (default: the end, then the
    attributes).  Times may come as timestamps, dates or ISO text, mixed as they like; all are compared as
    instants.  A NULL in a key or a time matches nothing.

    Facts and dimension are merged on one timeline, keys in ``hot`` in cells of ``width``: no key meets all of
    its intervals.  For ``rank`` the dimension is first brought to one winner from each start or end on, over dyadic
    cells: logarithmically many rows per interval, however long it is and however many overlap.  ``direct`` joins on key and range instead, for dimensions with few intervals per key; both
    forms give the same rows.
    """
    if resolve not in ("repair", "rank"):
        raise ValueError(f"unknown resolution {resolve!r}")
    attrs = list(take)
    side = _ranked(dim, keys, lo, hi, [*(ties or [hi]), *[a for a in attrs if a not in ties]], attrs)
    timed = fact.withColumn("_at", F.col(at).cast("timestamp_ntz"))
    if direct:
        found = _direct(timed, side, keys, resolve, fact_key)
    elif resolve == "repair":
        found = _merged(timed, side, keys, width, max_rows, hot)
    else:
        found = _merged_rank(timed, side, keys, width, max_rows, hot)
    out = [
        F.col(f"_hit.{a}").alias(a)
        if default is None
        else F.coalesce(F.col(f"_hit.{a}"), F.lit(default)).alias(a)
        for a, default in take.items()
    ]
    return found.select(*fact.columns, *out)


def _ranked(dim: DataFrame, keys, lo: str, hi: str, ties: Sequence[str], attrs: Sequence[str]) -> DataFrame:
    """keys, ``_lo``, ``_hi``, ``_hit``: what an interval gives, ordered as intervals are ranked."""
    start, end = (F.col(c).cast("timestamp_ntz") for c in (lo, hi))
    worst_first = W.partitionBy(*keys, "_lo").orderBy(*[F.col(c).desc_nulls_first() for c in ties])
    known = dim.withColumns({"_lo": start, "_hi": end}).filter(F.col("_lo").isNotNull())
    numbered = known.withColumn("_no", F.row_number().over(worst_first))
    hit = F.struct(F.col("_lo").alias("_rank0"), F.col("_no").alias("_rank1"), *[F.col(a).alias(a) for a in attrs])
    return numbered.select(*keys, "_lo", "_hi", hit.alias("_hit"))


def _direct(fact, side, keys, resolve, fact_key) -> DataFrame:
    if resolve == "repair":
        side = close_intervals(side, keys, "_lo", "_hi", ["_hit"])
    side = side.withColumnsRenamed({k: f"_d_{k}" for k in keys})
    cond = in_interval(F.col("_at"), F.col("_lo"), F.col("_hi"))
    for k in keys:
        cond = cond & (F.col(k) == F.col(f"_d_{k}"))
    joined = fact.join(side, cond, "left")
    if resolve == "rank":
        latest = W.partitionBy(*fact_key).orderBy(F.col("_hit").desc_nulls_last())
        joined = joined.withColumn("_rn", F.row_number().over(latest)).filter("_rn = 1")
    return joined


def _merged(fact, side, keys, width, max_rows, hot) -> DataFrame:
    """The last start at or before the fact, kept if its interval has not ended."""
    seen = last_known(fact, side, keys, "_at", "_lo", ["_lo", "_hi", "_hit"], ["_hit"], width, max_rows, hot)
    covered = in_interval(F.col("_at"), F.col("_lo"), F.col("_hi"))
    return seen.withColumn("_hit", F.when(covered, F.col("_hit")))


def _merged_rank(fact, side, keys, width, max_rows, hot) -> DataFrame:
    """Which interval wins from each of its key's starts and ends on, looked up as of the fact."""
    steps = highest_cover(side, keys, "_lo", "_hi", "_hit", "_since")
    return last_known(fact, steps, keys, "_at", "_since", ["_hit"], [], width, max_rows, hot)


def exclude_intervals(
    fact: DataFrame,
    windows: DataFrame,
    keys: Sequence[str],
    at: str,
    lo: str,
    hi: str,
    width: timedelta = timedelta(days=1),
    max_rows: int | None = None,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Drop facts inside any of their own windows.

    Facts and windows share one timeline per key: a window opens at its start and closes at its end, and a
    fact with a window open behind it goes.  That is two rows per window however long it is, and nothing
    can fan out.  Keys in ``hot`` are worked in cells of ``width``.  A NULL in a key, a start or the fact's
    time matches nothing; a window that ends before it starts is empty.
    """
    start, end = (F.col(c).cast("timestamp_ntz") for c in (lo, hi))
    real = start.isNotNull() & (end.isNull() | (start < end))
    for k in keys:
        real = real & F.col(k).isNotNull()
    opens = F.struct(start.alias("_tick"), F.lit(1).cast("bigint").alias("_move"))
    closes = F.struct(end.alias("_tick"), F.lit(-1).cast("bigint").alias("_move"))
    moves = windows.filter(real).select(*keys, F.explode(F.array(opens, closes)).alias("_m"))
    moves = moves.select(*keys, "_m.*", F.lit(0).alias("_kind")).filter(F.col("_tick").isNotNull())
    timed = fact.withColumns(
        {"_tick": F.col(at).cast("timestamp_ntz"), "_move": F.lit(0).cast("bigint"), "_kind": F.lit(1)}
    )
    # Facts without a time sort before every window.
    line = timed.unionByName(moves, allowMissingColumns=True)
    total = running_total(line, keys, "_tick", "_move", "_open", ["_kind"], scale=0, width=width, max_rows=max_rows, hot=hot)
    return total.filter((F.col("_kind") == 1) & (F.col("_open") == 0)).select(*fact.columns)
