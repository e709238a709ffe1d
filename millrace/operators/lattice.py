"""Several grains of one aggregation, rolled up from each other instead of from the rows.

Rows are grouped once, at the finest grain, into states that can be merged.  Every coarser grain merges the states of the
smallest grain above it.  Raw rows are neither repeated nor shuffled again: all grains read the finest one's shuffle, and
what they move are groups.  Exact distinct counts keep the counted column in the groups until the last step of a grain.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.values import SUM_SCALE, exact_parts, exact_value

Grain = tuple[str, ...]


@dataclass(frozen=True)
class Measure:
    """``states`` are aggregates over rows, ``merge`` says how each is merged, ``final`` makes the value of them.

    ``distinct`` names a column whose values are counted; such a measure has no states of its own.
    """

    states: Sequence[Column] = ()
    merge: Callable[[Column], Column] = F.sum
    final: Callable[..., Column] = lambda *states: states[0]
    distinct: str | None = None


def total(c: str) -> Measure:
    return Measure([F.sum(c)])


def rows() -> Measure:
    return Measure([F.count(F.lit(1))])


def known(c: str) -> Measure:
    return Measure([F.count(c)])


def rows_where(cond: Column) -> Measure:
    return Measure([F.count_if(cond)])


def low(c: str) -> Measure:
    return Measure([F.min(c)], F.min)


def high(c: str) -> Measure:
    return Measure([F.max(c)], F.max)


def exact(c: str | Column, digits: int | None = None, scale: int = SUM_SCALE) -> Measure:
    """The exact sum as double, as ``exact_sum`` gives it."""
    return Measure(exact_parts(c, scale), F.sum, lambda *s: exact_value(*s, scale=scale, digits=digits))


def mean(c: str, digits: int = 2, scale: int = SUM_SCALE) -> Measure:
    """The exact average, rounded half up, as ``exact_avg`` gives it."""
    return Measure([*exact_parts(c, scale), F.count(c)], F.sum, lambda *s: exact_value(*s[:3], scale=scale, digits=digits, over=s[3]))


def distinct(c: str) -> Measure:
    return Measure(distinct=c)


def grains_of(dims: Sequence[str], grains: str | Sequence[Sequence[str]]) -> list[Grain]:
    """The subsets of the dimensions that are asked for, each in the order of ``dims``."""
    if grains == "cube":
        return [g for n in range(len(dims), -1, -1) for g in combinations(dims, n)]
    if grains == "rollup":
        return [tuple(dims[:n]) for n in range(len(dims), -1, -1)]
    return [tuple(d for d in dims if d in set(g)) for g in grains]


def grain_number(dims: Sequence[str], grain: Grain) -> int:
    """As SQL numbers grouping sets: a bit for each dimension that is rolled up, the first dimension highest."""
    return sum(1 << (len(dims) - 1 - i) for i, d in enumerate(dims) if d not in grain)


def rolled_up(
    df: DataFrame,
    dims: Sequence[str],
    measures: Mapping[str, Measure],
    grains: str | Sequence[Sequence[str]] = "cube",
    sizes: Mapping[Grain, int] | None = None,
) -> DataFrame:
    """dims (NULL where rolled up), measures and ``grain_id``.  ``sizes`` are known or estimated numbers of groups; without
    them the parent of fewest dimensions is taken for the smallest."""
    asked = grains_of(dims, grains)
    counted = list(dict.fromkeys(m.distinct for m in measures.values() if m.distinct))
    plain = {n: m for n, m in measures.items() if not m.distinct}
    branches = []
    for c in counted or [None]:
        own = {n: m for n, m in measures.items() if m.distinct and m.distinct == c} | (plain if c == (counted or [None])[0] else {})
        branches.append(_branch(df, dims, own, asked, c, sizes or {}))
    if len(branches) == 1:
        return branches[0].select(*dims, *measures, "grain_id")
    # Results of several counted columns meet as groups of the report.
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), branches)
    return both.groupBy(*dims, "grain_id").agg(*[F.max(n).alias(n) for n in measures]).select(*dims, *measures, "grain_id")


def _branch(df, dims, measures, asked, counted, sizes) -> DataFrame:
    states = {f"_{n}_{i}": (s, m.merge) for n, m in measures.items() for i, s in enumerate(m.states)}
    finest: Grain = tuple(d for d in dims if any(d in g for g in asked))
    held = [counted] if counted else []
    if counted in dims:  # a dimension that is counted as well
        df, held = df.withColumn("_counted", F.col(counted)), ["_counted"]
    none = [F.count(F.lit(1)).alias("_n")] if not states else []
    tables = {finest: df.groupBy(*finest, *held, F.lit(0).alias("_all")).agg(*[s.alias(k) for k, (s, _) in states.items()], *none)}
    merged = [merge(F.col(k)).alias(k) for k, (_, merge) in states.items()]
    out = []
    for grain in sorted(set(asked) | {finest}, key=lambda g: (-len(g), dims.index(g[0]) if g else 0)):
        if grain not in tables:
            above = [g for g in tables if set(grain) < set(g)]
            parent = min(above, key=lambda g: (sizes.get(g, float("inf")), len(g)))
            tables[grain] = tables[parent].groupBy(*grain, *held, "_all").agg(*merged, *([F.sum("_n").alias("_n")] if none else []))
    for grain in asked:
        table = tables[grain]
        values = {n: m.final(*[F.col(f"_{n}_{i}") for i in range(len(m.states))]) for n, m in measures.items() if not m.distinct}
        if counted:
            number = [F.count(held[0]).alias(f"_{n}") for n, m in measures.items() if m.distinct]
            table = table.groupBy(*grain, "_all").agg(*merged, *number)
            values |= {n: F.col(f"_{n}") for n, m in measures.items() if m.distinct}
        kinds = {d: df.schema[d].dataType for d in dims}
        shown = [F.col(d) if d in grain else F.lit(None).cast(kinds[d]).alias(d) for d in dims]
        number = F.lit(grain_number(dims, grain)).cast("bigint").alias("grain_id")
        out.append(table.select(*shown, *[v.alias(n) for n, v in values.items()], number))
    return reduce(DataFrame.unionByName, out)
