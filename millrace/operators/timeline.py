"""Ordered operators on one key's timeline that do not need a hot key in one task.

A window partitioned by the key alone is one shuffle and right for every key of ordinary size; it is what
every operator does unless told otherwise.  The keys handed in as ``hot`` (or, with ``max_rows``, those that
a census finds to have more rows, see ``crowded``) get their timeline cut into fixed-width cells and are
worked per (key, cell).  What crosses a cell border travels as one summary row per (key, cell): the last
event, the running total, the last known value.  Only those summaries are windowed by the hot key, and a
key has at most ``time span / width`` of them.

The carried summary re-enters its cell as a *ghost* row that sorts before (or after) the real rows and
is filtered out at the end.  That keeps NULL keys in their group, and shuffles the rows once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.timing import cell_of, epoch_s, epoch_us, seconds_between, width_us
from ..functions.values import major, minor, same_values
from .joins import join_spread
from .skew import crowded, flag_keys

DAY = timedelta(days=1)

_CELL, _GHOST, _TAKE, _HOT = "_cell", "_ghost", "_take", "_hot"
_UP_TO_HERE = (W.unboundedPreceding, W.currentRow)


def _resolve(hot: DataFrame | None, df: DataFrame, keys: Sequence[str], max_rows: int | None):
    return crowded(df, keys, max_rows) if hot is None and max_rows is not None else hot


def _placed(df: DataFrame, keys: Sequence[str], cell: Column, hot: DataFrame) -> DataFrame:
    """Rows with their cell; every ordinary key has a single cell."""
    flagged = flag_keys(df, hot, keys, _HOT)
    return flagged.withColumn(_CELL, F.when(F.col(_HOT), cell).otherwise(F.lit(0)))


def _beside(
    df: DataFrame,
    keys: Sequence[str],
    at: str,
    ties: Sequence[str],
    take: Mapping[str, str],
    width: timedelta,
    hot: DataFrame | None,
    back: bool,
) -> DataFrame:
    order = [at, *ties]
    step = F.lag if back else F.lead
    values = F.struct(*[F.col(c).alias(c) for c in take])
    out = [*df.columns, *[F.col(f"_near.{c}").alias(name) for c, name in take.items()]]
    if hot is None:
        plain = W.partitionBy(*keys).orderBy(*order)
        return df.withColumn("_near", step(values).over(plain)).select(*out)
    rows = _placed(df, keys, cell_of(at, width), hot)
    pick = F.max_by if back else F.min_by
    edges = (
        rows.filter(_HOT).groupBy(*keys, _CELL).agg(pick(values, F.struct(*order)).alias(_TAKE))
    )
    across = W.partitionBy(*keys).orderBy(_CELL)
    ghosts = (
        edges.withColumn(_TAKE, step(_TAKE).over(across))
        .filter(F.col(_TAKE).isNotNull())
        .withColumn(_GHOST, F.lit(True))
    )
    both = rows.withColumns({_TAKE: values, _GHOST: F.lit(False)}).unionByName(
        ghosts, allowMissingColumns=True
    )
    ghost_place = F.col(_GHOST).desc() if back else F.col(_GHOST).asc()
    inside = W.partitionBy(*keys, _CELL).orderBy(ghost_place, *order)
    return both.withColumn("_near", step(_TAKE).over(inside)).filter(~F.col(_GHOST)).select(*out)


def previous_in_key(
    df: DataFrame,
    keys: Sequence[str],
    at: str,
    take: Mapping[str, str],
    ties: Sequence[str] = (),
    width: timedelta = DAY,
    max_rows: int | None = None,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Values of the row before, as ``{column: name of its previous value}``.

    ``(at, *ties)`` must order the rows of a key totally; ``at`` is never NULL.  ``hot`` takes what
    ``crowded`` said about these rows or a superset of them.
    """
    return _beside(df, keys, at, ties, take, width, _resolve(hot, df, keys, max_rows), back=True)


def next_in_key(
    df: DataFrame,
    keys: Sequence[str],
    at: str,
    take: Mapping[str, str],
    ties: Sequence[str] = (),
    width: timedelta = DAY,
    max_rows: int | None = None,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Values of the row after; see ``previous_in_key``."""
    return _beside(df, keys, at, ties, take, width, _resolve(hot, df, keys, max_rows), back=False)


def time_delta(
    df: DataFrame,
    keys: Sequence[str],
    at: str,
    ties: Sequence[str] = (),
    name: str = "delta_s",
    width: timedelta = DAY,
    max_rows: int | None = None,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Whole seconds since the key's previous event; 0 for its first."""
    seen = previous_in_key(df, keys, at, {at: "_prev_at"}, ties, width, max_rows, hot)
    gap = F.coalesce(seconds_between("_prev_at", at), F.lit(0).cast("bigint"))
    return seen.withColumn(name, gap).drop("_prev_at")


def running_total(
    df: DataFrame,
    keys: Sequence[str],
    at: str,
    value: str,
    name: str,
    ties: Sequence[str] = (),
    peers: bool = False,
    scale: int = 2,
    width: timedelta = DAY,
    max_rows: int | None = None,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Running exact sum per key.  ``peers`` counts rows of the same instant together (RANGE frame)."""
    hot = _resolve(hot, df, keys, max_rows)
    order = [at] if peers else [at, *ties]

    def frame(spec):
        return spec.rangeBetween(*_UP_TO_HERE) if peers else spec.rowsBetween(*_UP_TO_HERE)

    if hot is None:
        total = F.sum(minor(value, scale)).over(frame(W.partitionBy(*keys).orderBy(*order)))
        return df.withColumn(name, major(total, scale))
    rows = _placed(df.withColumn("_v", minor(value, scale)), keys, cell_of(at, width), hot)
    ghosts = _carry_totals(rows, keys, "_v")
    inside = frame(W.partitionBy(*keys, _CELL).orderBy(F.col(_GHOST).desc(), *order))
    both = rows.withColumn(_GHOST, F.lit(False)).unionByName(ghosts, allowMissingColumns=True)
    return (
        both.withColumn(name, major(F.sum("_v").over(inside), scale))
        .filter(~F.col(_GHOST))
        .select(*df.columns, name)
    )


def _carry_totals(rows: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """One ghost per (hot key, cell) with the sum of all earlier cells, placed before the cell's rows."""
    before = W.partitionBy(*keys).orderBy(_CELL).rowsBetween(W.unboundedPreceding, -1)
    return (
        rows.filter(_HOT)
        .groupBy(*keys, _CELL)
        .agg(F.sum(value).alias("_total"))
        .withColumn(value, F.sum("_total").over(before))
        .filter(F.col(value).isNotNull())
        .select(*keys, _CELL, value, F.lit(True).alias(_GHOST))
    )


def rolling_sum(
    df: DataFrame,
    keys: Sequence[str],
    at: str,
    value: str,
    span: timedelta,
    name: str,
    scale: int = 4,
    width: timedelta = DAY,
    max_rows: int | None = None,
    hot: DataFrame | None = None,
    slide: bool = False,
) -> DataFrame:
    """Sum over the trailing ``span`` up to and including the row, on whole seconds, exact to ``scale``.

    A row enters a balance at its second and leaves it one second after its span: the rolling sum is a running
    total of entries and expiries, linear in the rows, and hot keys are cut into cells that may be far shorter
    than the span.  ``slide`` takes a sliding frame instead, which adds up its rows again for every row: for
    short keys only.
    """
    seconds = width_us(span) // 1_000_000
    timed = df.withColumns({"_tick": epoch_s(at), "_v": minor(value, scale)})
    if slide:
        frame = W.partitionBy(*keys).orderBy("_tick").rangeBetween(-seconds, 0)
        return timed.withColumn(name, major(F.sum("_v").over(frame), scale)).select(*df.columns, name)
    hot = _resolve(hot, df, keys, max_rows)
    enters = F.struct(F.lit(False).alias("leaves"), F.col("_tick").alias("tick"), F.col("_v").alias("v"))
    leaves = F.struct(
        F.lit(True).alias("leaves"), (F.col("_tick") + seconds + 1).alias("tick"), (-F.col("_v")).alias("v")
    )
    moves = (
        timed.withColumn("_move", F.explode(F.array(enters, leaves)))
        .withColumns({"_leaves": F.col("_move.leaves"), "_tick": F.col("_move.tick"), "_v": F.col("_move.v")})
        .drop("_move")
    )
    if hot is None:
        balance = W.partitionBy(*keys).orderBy("_tick").rangeBetween(*_UP_TO_HERE)
        total = moves.withColumn(name, major(F.sum("_v").over(balance), scale))
        return total.filter(~F.col("_leaves")).select(*df.columns, name)
    cell = F.col("_tick") - F.pmod("_tick", F.lit(width_us(width) // 1_000_000))
    ledger = _placed(moves, keys, cell, hot)
    ghosts = _carry_totals(ledger, keys, "_v")
    both = ledger.withColumn(_GHOST, F.lit(False)).unionByName(ghosts, allowMissingColumns=True)
    inside = (
        W.partitionBy(*keys, _CELL).orderBy(F.col(_GHOST).desc(), "_tick").rangeBetween(*_UP_TO_HERE)
    )
    return (
        both.withColumn(name, major(F.sum("_v").over(inside), scale))
        .filter(~F.col(_GHOST) & ~F.col("_leaves"))
        .select(*df.columns, name)
    )


def _gap_cells(
    df: DataFrame, keys: Sequence[str], at: str, gap: timedelta, measures: Mapping[str, tuple[str, str]]
) -> DataFrame:
    """Cells as wide as the gap: two events of one cell are always in the same session.

    So a cell needs no ordering inside, only a combinable summary.
    """
    parts = [getattr(F, fn)(F.col(c)).alias(name) for name, (fn, c) in measures.items()]
    return (
        df.withColumn(_CELL, cell_of(at, gap))
        .groupBy(*keys, _CELL)
        .agg(
            F.min(at).alias("_first"),
            F.max(at).alias("_last"),
            F.count(F.lit(1)).alias("_n"),
            *parts,
        )
    )


def cell_summaries(df: DataFrame, keys: Sequence[str], at: str, gap: timedelta) -> DataFrame:
    """keys, ``_first``, ``_last`` and ``_n`` of each cell of the gap's width."""
    return _gap_cells(df, keys, at, gap, {}).drop(_CELL)


def _session_labels(cells: DataFrame, keys: Sequence[str], gap: timedelta, label: str) -> DataFrame:
    """Number the sessions of a key, or name each by its start, over the cell summaries."""
    order = W.partitionBy(*keys).orderBy(_CELL)
    so_far = order.rowsBetween(W.unboundedPreceding, W.currentRow)
    prev = F.lag("_last").over(order)
    opens = prev.isNull() | (F.timestamp_diff("MICROSECOND", prev, F.col("_first")) > width_us(gap))
    marked = cells.withColumn("_opens", opens)
    if label == "start":
        tag = F.max(F.when(F.col("_opens"), F.col("_first"))).over(so_far)
    else:
        tag = F.sum(F.col("_opens").cast("bigint")).over(so_far)
    return marked.withColumn("_session", tag)


def gap_sessions(
    df: DataFrame,
    keys: Sequence[str],
    at: str,
    gap: timedelta,
    measures: Mapping[str, tuple[str, str]] | None = None,
    label: str = "number",
) -> DataFrame:
    """Sessions: maximal runs in which each event follows the one before by at most ``gap``.

    Emits ``session_start``, ``session_end`` (the last event), ``n_events`` and any extra ``measures``
    as ``{name: ("sum" | "min" | "max", column)}``.  Events are combined before the first shuffle; the
    per-key pass sees at most ``span / gap`` rows of a key, however many events it has.
    """
    extra = dict(measures or {})
    cells = _gap_cells(df, keys, at, gap, extra)
    tagged = _session_labels(cells, keys, gap, label)
    again = [getattr(F, fn)(F.col(name)).alias(name) for name, (fn, _) in extra.items()]
    return (
        tagged.groupBy(*keys, "_session")
        .agg(
            F.min("_first").alias("session_start"),
            F.max("_last").alias("session_end"),
            F.sum("_n").alias("n_events"),
            *again,
        )
        .drop("_session")
    )


def native_sessions(df: DataFrame, keys: Sequence[str], at: str, gap: timedelta) -> DataFrame:
    """The same sessions through Spark's ``session_window``.

    The built-in merges raw rows per key without combining them first.  It is fed the cell summaries
    instead, each with a dynamic gap that reaches from its first event to ``gap`` past its last one.
    """
    cells = _gap_cells(df, keys, at, gap, {})
    reach = F.timestamp_diff("MICROSECOND", F.col("_first"), F.col("_last")) + F.lit(width_us(gap))
    window = F.session_window("_first", F.concat(reach.cast("string"), F.lit(" microseconds")))
    return cells.groupBy(*keys, window).agg(
        F.min("_first").alias("session_start"),
        F.max("_last").alias("session_end"),
        F.sum("_n").alias("n_events"),
    ).drop("session_window")


def label_sessions(
    df: DataFrame,
    keys: Sequence[str],
    at: str,
    gap: timedelta,
    name: str = "session_start",
    max_rows: int | None = None,
) -> DataFrame:
    """Every event with the start of its session.  Rows meet their label on (key, cell)."""
    cells = _gap_cells(df, keys, at, gap, {})
    tags = _session_labels(cells, keys, gap, "start").select(
        *keys, _CELL, F.col("_session").alias(name)
    )
    rows = df.withColumn(_CELL, cell_of(at, gap))
    return join_spread(rows, tags, [*keys, _CELL], "inner", max_rows).drop(_CELL)


def longest_streak(df: DataFrame, keys: Sequence[str], day: str, name: str = "longest_streak") -> DataFrame:
    """Longest run of consecutive days per key; days are made distinct before anything is ordered."""
    days = df.select(*keys, F.col(day).cast("date").alias("_day")).distinct()
    order = W.partitionBy(*keys).orderBy("_day")
    island = F.date_sub("_day", F.row_number().over(order))
    runs = days.withColumn("_island", island).groupBy(*keys, "_island").agg(F.count(F.lit(1)).alias("_len"))
    return runs.groupBy(*keys).agg(F.max("_len").alias(name))


def _day_frame(keys: Sequence[str], day: str, lo: int, hi: int):
    return W.partitionBy(*keys).orderBy(F.unix_date(day)).rangeBetween(lo, hi)


def trailing_avg(
    df: DataFrame,
    keys: Sequence[str],
    day: str,
    value: str,
    days: int,
    name: str,
    digits: int = 2,
    scale: int = 4,
) -> DataFrame:
    """Average over the trailing calendar days, missing days counting as zero.

    The input holds at most one row per (key, day), so a key has no more rows than calendar days.
    """
    total = F.sum(minor(value, scale)).over(_day_frame(keys, day, -(days - 1), 0))
    return df.withColumn(name, F.round(total / F.lit(float(days * 10**scale)), digits))


def dense_trailing_avg(
    df: DataFrame,
    keys: Sequence[str],
    day: str,
    value: str,
    days: int,
    name: str,
    digits: int = 2,
    scale: int = 4,
) -> DataFrame:
    """The same number by filling the calendar of each key and counting rows instead of days."""
    bounds = df.groupBy(*keys).agg(F.min(day).alias("_lo"), F.max(day).alias("_hi"))
    calendar = bounds.select(*keys, F.explode(F.sequence("_lo", "_hi")).alias(day))
    full = calendar.join(df, [*keys, day], "left")
    frame = W.partitionBy(*keys).orderBy(day).rowsBetween(-(days - 1), W.currentRow)
    total = F.sum(F.coalesce(minor(value, scale), F.lit(0))).over(frame)
    averaged = full.withColumn(name, F.round(total / F.lit(float(days * 10**scale)), digits))
    return averaged.join(df.select(*keys, day), [*keys, day], "left_semi").select(*df.columns, name)


def value_at_offset(
    df: DataFrame, keys: Sequence[str], day: str, value: str, offset: int, name: str, default: object = 0.0
) -> DataFrame:
    """Value on the day ``offset`` days away; a day without a row gives the default."""
    there = F.max(value).over(_day_frame(keys, day, offset, offset))
    return df.withColumn(name, F.coalesce(there, F.lit(default)))


def versions(
    df: DataFrame,
    keys: Sequence[str],
    at: str,
    attrs: Sequence[str],
    ties: Sequence[str] = (),
    width: timedelta = DAY,
    max_rows: int | None = None,
    hot: DataFrame | None = None,
) -> DataFrame:
    """SCD2 history of a snapshot feed: one half-open row per run of equal attribute values.

    A replayed value opens no version, a value that comes back does.  NULL is a value.
    """
    hot = _resolve(hot, df, keys, max_rows)
    take = {at: "_prev_at", **{a: f"_prev_{a}" for a in attrs}}
    seen = previous_in_key(df, keys, at, take, ties, width, hot=hot)
    same = same_values([(F.col(a), F.col(f"_prev_{a}")) for a in attrs])
    starts = seen.filter(F.col("_prev_at").isNull() | ~same).select(
        *keys, F.col(at).alias("effective_from"), *ties, *attrs
    )
    closed = close_next(starts, keys, "effective_from", ties, width, hot=hot)
    return closed.drop(*ties) if ties else closed


def close_next(
    df: DataFrame,
    keys: Sequence[str],
    start: str,
    ties: Sequence[str] = (),
    width: timedelta = DAY,
    end: str = "effective_to",
    max_rows: int | None = None,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Each row ends where the key's next one starts; the open one is current."""
    out = next_in_key(df, keys, start, {start: end}, ties, width, max_rows, hot)
    return out.withColumn("is_current", F.col(end).isNull())


def last_known(
    facts: DataFrame,
    history: DataFrame,
    keys: Sequence[str],
    at: str,
    since: str,
    take: Sequence[str],
    ties: Sequence[str] = (),
    width: timedelta = DAY,
    max_rows: int | None = None,
    hot: DataFrame | None = None,
) -> DataFrame:
    """As-of lookup: per fact the history row with the latest ``since <= at``, if there is one.  A NULL in a
    key is never known.

    Facts and history are merged on one timeline, so no fact-history pair is ever emitted, and a key
    with many facts and many history rows costs their sum, not their product.
    """
    payload = F.struct(*[F.col(c).alias(c) for c in take])
    marks = history.select(
        *keys,
        epoch_us(since).alias("_tick"),
        F.struct(since, *ties).alias("_rank"),
        payload.alias(_TAKE),
        F.lit(1).alias("_kind"),
    )
    rows = facts.withColumns({"_tick": epoch_us(at), "_kind": F.lit(2)})
    merged = rows.unionByName(marks, allowMissingColumns=True)
    hot = _resolve(hot, merged, keys, max_rows)
    parts = list(keys)
    if hot is not None:
        step = F.lit(width_us(width))
        placed = _placed(merged, keys, F.col("_tick") - F.pmod("_tick", step), hot)
        before = W.partitionBy(*keys).orderBy(_CELL).rowsBetween(W.unboundedPreceding, -1)
        ghosts = (
            placed.filter(_HOT)
            .groupBy(*keys, _CELL)
            .agg(F.max_by(_TAKE, "_rank").alias("_edge"))
            .withColumn(_TAKE, F.last("_edge", ignorenulls=True).over(before))
            .filter(F.col(_TAKE).isNotNull())
            .select(*keys, _CELL, _TAKE, F.lit(0).alias("_kind"))
        )
        merged = placed.unionByName(ghosts, allowMissingColumns=True)
        parts.append(_CELL)
    inside = (
        W.partitionBy(*parts)
        .orderBy(F.col("_kind") != 0, "_tick", "_kind", F.col("_rank").asc_nulls_first())
        .rowsBetween(*_UP_TO_HERE)
    )
    keyed = F.lit(True)
    for k in keys:
        keyed = keyed & F.col(k).isNotNull()
    return (
        merged.withColumn("_known", F.when(keyed, F.last(_TAKE, ignorenulls=True).over(inside)))
        .filter(F.col("_kind") == 2)
        .select(*facts.columns, *[F.col(f"_known.{c}").alias(c) for c in take])
    )
