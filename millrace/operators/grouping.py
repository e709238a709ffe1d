"""Aggregations at one grain, at several grains in one scan, and pivots."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.values import exact_sum
from .lattice import Measure, grains_of, grain_number, rolled_up


def _named(aggs: Mapping[str, Column]) -> list[Column]:
    return [e.alias(name) for name, e in aggs.items()]


def summarise(df: DataFrame, keys: Sequence[str | Column], aggs: Mapping[str, Column]) -> DataFrame:
    return df.groupBy(*keys).agg(*_named(aggs))


def collect_sorted(
    df: DataFrame, keys: Sequence[str], col: str, name: str, total: str | None = None
) -> DataFrame:
    """Distinct non-NULL values per key as a sorted array, and how many values went in.

    Values are made distinct by a combinable count first; only distinct ones are ever collected.
    """
    distinct = df.groupBy(*keys, col).agg(F.count(col).alias("_n"))
    aggs = {name: F.array_sort(F.collect_list(col))}
    if total:
        aggs[total] = F.sum("_n")
    return distinct.groupBy(*keys).agg(*_named(aggs))


def level_label(dims: Sequence[str], levels: Mapping[frozenset[str] | tuple[str, ...], str]) -> Column:
    """Label of the grain from the grouping bits, never from a NULL test."""
    out = None
    for kept, label in levels.items():
        cond = F.lit(True)
        for d in dims:
            cond = cond & (F.grouping(d) == (0 if d in kept else 1))
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out


def multi_grain(
    df: DataFrame,
    dims: Sequence[str],
    aggs: Mapping[str, Column | Measure],
    grains: str | Sequence[Sequence[str]] = "cube",
    levels: Mapping[tuple[str, ...], str] | None = None,
    all_labels: str | Mapping[str, str] = "ALL",
    null_labels: Mapping[str, str] | None = None,
    level: str = "level",
) -> DataFrame:
    """All requested grains in one scan.

    ``grains`` is ``cube``, ``rollup`` or the list of dimension subsets to emit.  A rolled-up dimension
    shows its ALL label; a real NULL in the data stays NULL (or takes its ``null_labels`` entry).  Dimensions
    are shown as text, whatever their type.

    Measures of ``lattice`` are worked out once per group of the finest grain and rolled up from there.  Plain
    aggregates take Spark's own grouping sets, which repeat every row for each grain: for those that cannot be merged.
    """
    if all(isinstance(a, Measure) for a in aggs.values()):
        raw = rolled_up(df, dims, aggs, grains)
        asked, kept = grains_of(dims, grains), {frozenset(k): v for k, v in (levels or {}).items()}
        if levels:
            named = F.create_map(*[F.lit(x) for g in asked for x in (grain_number(dims, g), kept.get(frozenset(g)))])
            raw = raw.withColumn(level, named[F.col("grain_id").cast("int")])
        bit = lambda i: F.col("grain_id").bitwiseAND(F.lit(1 << (len(dims) - 1 - i))) != 0
        shown = {d: _shown(d, bit(i), all_labels, null_labels) for i, d in enumerate(dims)}
        return raw.withColumns(shown).select(*dims, *aggs, *([level] if levels else []), "grain_id")
    if grains == "cube":
        grouped = df.cube(*dims)
    elif grains == "rollup":
        grouped = df.rollup(*dims)
    else:
        grouped = df.groupingSets([[F.col(c) for c in g] for g in grains], *[F.col(d) for d in dims])
    extra = []
    if levels:
        extra.append(level_label(dims, levels).alias(level))
    bits = [F.grouping(d).alias(f"_g_{d}") for d in dims]
    raw = grouped.agg(*_named(aggs), *extra, F.grouping_id().alias("grain_id"), *bits)
    shown = {d: _shown(d, F.col(f"_g_{d}") == 1, all_labels, null_labels) for d in dims}
    return raw.withColumns(shown).drop(*[f"_g_{d}" for d in dims])


def _shown(d: str, rolled: Column, all_labels: str | Mapping[str, str], null_labels: Mapping[str, str] | None) -> Column:
    value = F.col(d).cast("string")
    if null_labels and d in null_labels:
        value = F.coalesce(value, F.lit(null_labels[d]))
    return F.when(rolled, F.lit(all_labels if isinstance(all_labels, str) else all_labels[d])).otherwise(value)


def cube_then_filter(
    df: DataFrame, dims: Sequence[str], aggs: Mapping[str, Column], drop_ids: Sequence[int]
) -> DataFrame:
    """Route to the same grains as grouping sets: compute every grain, drop the unwanted ones."""
    raw = df.cube(*dims).agg(*_named(aggs), F.grouping_id().alias("grain_id"))
    return raw.filter(~F.col("grain_id").isin(*drop_ids))


def pivot_sum(
    df: DataFrame, keys: Sequence[str], col: str, values: Sequence[str], measure: Column, fill: object = None
) -> DataFrame:
    """One column per listed value; other values are dropped, missing cells take ``fill``."""
    wide = df.groupBy(*keys).pivot(col, list(values)).agg(measure)
    if fill is None:
        return wide
    kinds = dict(wide.dtypes)
    return wide.withColumns(
        {v: F.coalesce(F.col(f"`{v}`"), F.lit(fill).cast(kinds[v])) for v in values}
    )


def pivot_dynamic(df: DataFrame, keys: Sequence[str], col: str, measure: Column) -> DataFrame:
    """The data decide the columns: costs one more job, and the schema is not a contract."""
    return df.groupBy(*keys).pivot(col).agg(measure)


def pivot_multi(
    df: DataFrame, keys: Sequence[str], col: str, values: Sequence[str], aggs: Mapping[str, Column]
) -> DataFrame:
    """Several measures per value, as ``<value>_<measure>``."""
    return df.groupBy(*keys).pivot(col, list(values)).agg(*_named(aggs))


def pivot_by_condition(
    df: DataFrame, keys: Sequence[str], col: str, values: Sequence[str], measure: str
) -> DataFrame:
    """Portable pivot: one conditional sum per value, in a single aggregate."""
    cells = [
        F.coalesce(exact_sum(F.when(F.col(col) == v, F.col(measure))), F.lit(0.0)).alias(v) for v in values
    ]
    return df.groupBy(*keys).agg(*cells)
