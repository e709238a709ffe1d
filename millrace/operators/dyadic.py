"""Dyadic cells: an index of intervals with logarithmically many rows, whatever their length.

A cell of level k is ``2 ** k`` units long and begins at a multiple of that.  Every half-open interval is the disjoint union
of at most two cells per level; the cells that hold an instant are one per level.  The unit is the coarsest of day, hour,
minute, second, millisecond and microsecond that all ends are multiples of, so that no width has to be chosen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.timing import epoch_us, whole_div

_UNITS = (86_400_000_000, 3_600_000_000, 60_000_000, 1_000_000, 1_000, 1)


def _shift(value: Column, bits: Column) -> Column:
    return F.call_function("shiftright", value, bits)


def cells(first: Column, end: Column, top: Column) -> Column:
    """Array of (level, cell): the disjoint cells of levels 0 to ``top`` that make up ``[first, end)``."""

    def at(k: Column) -> Column:
        low, high = -_shift(-first, k), _shift(end, k)  # rounded up and down
        odd = lambda x: x.bitwiseAND(F.lit(1)) == 1
        cell = lambda x: F.struct(k.alias("level"), x.alias("cell"))
        return F.array(F.when((low < high) & odd(low), cell(low)), F.when((low < high) & odd(high), cell(high - 1)))

    return F.filter(F.flatten(F.transform(F.sequence(F.lit(0), top), at)), lambda c: c.isNotNull())


def measured(windows: DataFrame, lo: str, hi: str) -> DataFrame:
    """``windows`` in whole units: ``_first``, ``_end`` (an open end lies behind all others), ``_unit`` and ``_top``.

    Empty windows and those without a start are left out.  One combinable aggregate, whose single row joins the windows.
    """
    ticks = windows.withColumns({"_first": epoch_us(lo), "_end": epoch_us(hi)})
    ticks = ticks.filter(F.col("_first").isNotNull() & (F.col("_end").isNull() | (F.col("_first") < F.col("_end"))))
    whole = lambda u: F.every((F.pmod("_first", F.lit(u)) == 0) & F.coalesce(F.pmod("_end", F.lit(u)) == 0, F.lit(True)))
    unit = F.when(whole(_UNITS[0]), F.lit(_UNITS[0]))
    for u in _UNITS[1:]:
        unit = unit.when(whole(u), F.lit(u))
    scale = ticks.agg(
        unit.alias("_unit"),
        F.max(F.greatest("_first", "_end")).alias("_last"),
        F.max(F.col("_end") - F.col("_first")).alias("_long"),
        F.min(F.when(F.col("_end").isNull(), F.col("_first"))).alias("_since"),
    )
    limit = F.col("_last") + F.col("_unit")
    span = whole_div(F.greatest("_long", limit - F.col("_since")), F.col("_unit"))
    scale = scale.select("_unit", limit.alias("_limit"), (F.floor(F.log2(span)).cast("int") + 1).alias("_top"))
    out = ticks.crossJoin(F.broadcast(scale))  # one row
    return out.withColumns(
        {"_first": whole_div(F.col("_first"), F.col("_unit")), "_end": whole_div(F.coalesce("_end", "_limit"), F.col("_unit"))}
    ).drop("_limit")


def cell_rows(windows: DataFrame, keys: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """One row for each cell of each of the ``measured`` windows: keys, ``_level``, ``_cell`` and ``keep``.

    The cells of ``cells``, level by level as rows, whose arithmetic is compiled.
    """
    levels = windows.select(*keys, *keep, "_first", "_end", F.explode(F.sequence(F.lit(0), F.col("_top"))).alias("_level"))
    low, high = -_shift(-F.col("_first"), F.col("_level")), _shift(F.col("_end"), F.col("_level"))  # rounded up and down
    levels = levels.withColumns({"_low": low, "_high": high}).filter("_low < _high AND (_low & 1 = 1 OR _high & 1 = 1)")
    odd = lambda c: F.col(c).bitwiseAND(F.lit(1)) == 1
    ends = F.array(F.when(odd("_low"), F.col("_low")), F.when(odd("_high"), F.col("_high") - 1))
    return levels.select(*keys, "_level", F.explode(ends).alias("_cell"), *keep).filter(F.col("_cell").isNotNull())


def highest_cover(windows: DataFrame, keys: Sequence[str], lo: str, hi: str, rank: str, since: str) -> DataFrame:
    """keys, ``since``, ``rank``: from each instant on at which something begins or ends to be seen, the highest ``rank`` of
    the windows that cover it, NULL for none, until the key's next row.  ``rank`` orders windows by their start first.

    Of one start, windows show one after the other: the next best from where all better ones have ended.  These parts
    are disjoint, so that a start and where its part begins tell a window, and the latest start is all that a cell needs:
    numbers, which are aggregated without sorting.  Where a window starts nothing is asked, as it is the latest there.  A
    part covers its cells whole and an instant meets at most one row per level: neither long windows nor many that
    overlap multiply anything.  A NULL in a key covers nothing.
    """
    for k in keys:
        windows = windows.filter(F.col(k).isNotNull())
    sized = measured(windows.select(*keys, lo, hi, rank), lo, hi)
    better = W.partitionBy(*keys, lo).orderBy(F.col(rank).desc()).rowsBetween(W.unboundedPreceding, -1)
    parts = sized.withColumn("_from", F.coalesce(F.max("_end").over(better), F.col("_first"))).filter("_from < _end")
    cells_ = cell_rows(parts.select(*keys, F.col("_from").alias("_first"), "_end", "_top", F.col("_first").alias("_start"), "_from"), keys, ["_start", "_from"])
    latest = [F.max_by("_from", "_start").alias("_from"), F.max("_start").alias("_start")]
    index = cells_.groupBy(*keys, "_level", "_cell").agg(*latest)
    begun = parts.filter("_from = _first")
    begins = begun.select(*keys, "_unit", "_top", F.col("_first").alias("_tick"), F.lit(True).alias("_begins"))
    ends = parts.filter(F.col(hi).isNotNull()).select(*keys, "_unit", "_top", F.col("_end").alias("_tick"), F.lit(False).alias("_begins"))
    marks = begins.unionByName(ends).groupBy(*keys, "_unit", "_top", "_tick").agg(F.max("_begins").alias("_begins")).filter(~F.col("_begins"))
    asked = marks.select(*keys, "_unit", "_tick", F.explode(F.sequence(F.lit(0), F.col("_top"))).alias("_level"))
    asked = asked.withColumn("_cell", _shift(F.col("_tick"), F.col("_level")))
    found = asked.join(index, [*keys, "_level", "_cell"]).select(*keys, "_unit", "_tick", "_start", "_from")
    none = marks.select(*keys, "_unit", "_tick", F.lit(None).cast("bigint").alias("_start"), F.lit(None).cast("bigint").alias("_from"))
    best = found.unionByName(none).groupBy(*keys, "_unit", "_tick").agg(*latest)
    told = parts.select(*keys, F.col("_first").alias("_start"), "_from", rank)
    steps = best.join(told, [*keys, "_start", "_from"], "left").select(*keys, "_unit", "_tick", rank)
    steps = begun.select(*keys, "_unit", F.col("_first").alias("_tick"), rank).unionByName(steps)
    return steps.select(*keys, F.timestamp_micros(F.col("_tick") * F.col("_unit")).cast("timestamp_ntz").alias(since), rank)
