"""Best rows per key, without gathering a key's rows in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .joins import join_spread


def _sortable(df: DataFrame) -> list[str]:
    return [name for name, kind in df.dtypes if "map<" not in kind and kind != "variant"]


def keep_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key: the first by ``order`` (a plain name means largest first, NULLs last).

    The remaining columns break what ties are left, so the survivor never depends on row order.  The
    rank filter is applied per task before the shuffle, so a hot key sends one row per task.
    """
    named = [c for c in order if isinstance(c, str)]
    by = [F.col(c).desc_nulls_last() if isinstance(c, str) else c for c in order]
    rest = [c for c in _sortable(df) if c not in keys and c not in named]
    window = W.partitionBy(*keys).orderBy(*by, *[F.col(c).desc_nulls_last() for c in rest])
    return df.withColumn("_rn", F.row_number().over(window)).filter("_rn = 1").drop("_rn")


def keep_latest_counted(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], count: str = "n_versions"
) -> DataFrame:
    """The same survivor next to how many rows its key had.

    The survivor comes from a rank that is limited per task, the count from a hash aggregate over the keys
    alone: a maximum of whole rows would sort all of them before the shuffle.
    """
    kept = keep_latest(df, keys, order)
    counts = df.groupBy(*[F.col(k).alias(f"_c_{k}") for k in keys]).agg(F.count(F.lit(1)).alias(count))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_c_{k}"))
    return kept.join(counts, same).select(*keys, *[c for c in kept.columns if c not in keys], count)


def best_known(df: DataFrame, keys: Sequence[str], order: Sequence[Column], known: str) -> DataFrame:
    """Best row among those whose ranking value is known; a key without any gives no row."""
    return keep_latest(df.filter(F.col(known).isNotNull()), keys, order)


def argbest(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    payload: Sequence[str],
    how: str = "max",
) -> DataFrame:
    """Payload of the extreme row.  Mixed directions: negate a number inside ``order``.

    Rows whose first order value is NULL never win.
    """
    ranks = [*order, *[F.col(c) for c in payload]]
    by = [o.desc_nulls_last() if how == "max" else o.asc_nulls_first() for o in ranks]
    first = F.row_number().over(W.partitionBy(*keys).orderBy(*by))
    best = df.filter(order[0].isNotNull()).withColumn("_rn", first).filter("_rn = 1")
    return best.select(*keys, *payload)


def argbest_or_default(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    payload: Sequence[str],
    base: DataFrame,
    defaults: Sequence[object],
    how: str = "max",
) -> DataFrame:
    """``argbest`` joined back to ``base``, so a key without a winner still shows, with defaults."""
    found = base.join(argbest(df, keys, order, payload, how), list(keys), "left")
    return found.withColumns(
        {c: F.coalesce(F.col(c), F.lit(d)) for c, d in zip(payload, defaults) if d is not None}
    )


def top_n(
    df: DataFrame,
    keys: Sequence[str],
    by: str,
    n: int,
    rank: str = "dense",
    name: str = "rnk",
    ties: Sequence[str] = (),
    max_rows: int | None = None,
) -> DataFrame:
    """Rows in the top n per key, largest ``by`` first.

    ``row``     exactly n rows (``ties`` then all columns decide).
    ``dense``   n distinct values, with everybody who has one of them.
    ``rank``    competition ranks up to n.
    One scan and one shuffle, with a partial limit per task before it.  Where a single value may be shared by
    more rows than a task can sort, ``max_rows`` makes the two forms with ties rank the distinct values of a
    key first and give the rows their rank by joining on (key, value), such values spread.
    """
    if rank == "row":
        rest = [c for c in _sortable(df) if c not in keys and c != by and c not in ties]
        order = [F.col(c).desc_nulls_last() for c in (by, *ties, *rest)]
        window = W.partitionBy(*keys).orderBy(*order)
        return df.withColumn(name, F.row_number().over(window)).filter(F.col(name) <= n)
    ordered = W.partitionBy(*keys).orderBy(F.col(by).desc_nulls_last())
    if rank not in ("dense", "rank"):
        raise ValueError(f"unknown rank {rank!r}")
    if max_rows is None:
        number = F.dense_rank() if rank == "dense" else F.rank()
        return df.filter(F.col(by).isNotNull()).withColumn(name, number.over(ordered)).filter(F.col(name) <= n)
    values = (
        df.filter(F.col(by).isNotNull())
        .groupBy(*keys, by)
        .agg(F.count(F.lit(1)).alias("_cnt"))
        .withColumn("_dense", F.row_number().over(ordered))
        .filter(F.col("_dense") <= n)
    )
    if rank == "dense":
        ranked = values.withColumn(name, F.col("_dense"))
    else:
        above = ordered.rowsBetween(W.unboundedPreceding, -1)
        ahead = F.coalesce(F.sum("_cnt").over(above), F.lit(0).cast("bigint"))
        ranked = values.withColumn(name, (ahead + 1).cast("int")).filter(F.col(name) <= n)
    found = join_spread(df, ranked.select(*keys, by, name), [*keys, by], "inner", max_rows)
    return found.select(*df.columns, name)
