"""Hot keys: find them, and spread them over several tasks without changing the result."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.values import join_parts, odd_part, sum_parts
from .states import vocabulary

MAX_ROWS = 2_000_000
MAX_BROADCAST = 100_000
#: Keys that a task may count at once.
MOST_COUNTERS = 1 << 19


def crowded(df: DataFrame, keys: Sequence[str], max_rows: int = MAX_ROWS) -> DataFrame | None:
    """Keys with more than ``max_rows`` rows, or None if no key has.

    One combinable count over the key columns decides.  There are at most ``rows / max_rows`` such keys;
    they carry a broadcast hint while they number no more than ``MAX_BROADCAST``.
    A caller that filters ``df`` further may hand the same answer on: the set only shrinks.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    many = F.col("_n") > max_rows
    found = counts.agg(F.count_if(many)).first()[0]
    if not found:
        return None
    hot = counts.filter(many).select(*keys)
    return F.broadcast(hot) if found <= MAX_BROADCAST else hot


def flag_keys(df: DataFrame, hot: DataFrame, keys: Sequence[str], flag: str) -> DataFrame:
    """Rows of hot keys marked true, all others NULL; NULL is a key like any other."""
    named = hot.select(*[F.col(k).alias(f"_h_{k}") for k in keys], F.lit(True).alias(flag))
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_h_{k}"))
    return df.join(named, cond, "left").drop(*[f"_h_{k}" for k in keys])


def hot_keys(df: DataFrame, key: str, share: float = 0.01, verify: bool = False) -> DataFrame:
    """Keys holding at least ``share`` of all rows, found in one pass over the key column.

    Each task keeps counters for a bounded number of keys, which are merged (the frequent-items sketch behind
    ``approx_top_k``).  With m counters an estimate is at most ``3.5 / m`` of all rows off, and m is at least ``16 / share``:
    every key of that share is found, none below half of it is handed out, and there are at most ``2 / share`` of them, so
    they broadcast.  That is exact enough to spread keys by; ``verify`` counts the candidates, and only them, in a second
    pass.  NULL meets nothing in a join and is never hot.
    """
    counters = 1 << max(6, math.ceil(math.log2(16 / share)))
    if counters > MOST_COUNTERS:
        raise ValueError(f"a share of {share} is too small to track")
    top = F.call_function("approx_top_k", F.col(key), F.lit(math.ceil(2 / share) + 1), F.lit(counters))
    found, total = df.agg(top, F.count(F.lit(1))).first()
    likely = [r for r in found or [] if r["item"] is not None and r["count"] >= share * total]
    kind = df.schema[key].dataType.simpleString()
    hot = df.sparkSession.createDataFrame([(r["item"],) for r in likely], f"`{key}` {kind}")
    if verify and likely:
        counts = df.join(F.broadcast(hot), key, "left_semi").groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
        hot = counts.filter(F.col("_n") >= F.lit(share * total)).select(key)
    return F.broadcast(hot)


def salted_join(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    salt_from: str | None,
    n: int,
    hot: DataFrame | None = None,
    how: str = "inner",
    keep_salt: str | None = None,
) -> DataFrame:
    """Join on (key, salt): facts spread over n salts, the dimension repeated for each.

    The salt is the remainder of a stable integer column, so a rerun places rows alike;
    ``salt_from=None`` takes random salts instead.  With ``hot`` (see ``hot_keys``, which bounds its
    size) only those keys are spread and repeated; every other key stays on salt 0.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"{how!r} would show repeated dimension rows")
    salt = keep_salt or "_salt"
    if salt_from is None:
        spread = F.floor(F.rand() * n).cast("int")
    else:
        spread = F.pmod(F.col(salt_from), F.lit(n)).cast("int")
    every = F.sequence(F.lit(0), F.lit(n - 1))
    if hot is None:
        left = fact.withColumn(salt, spread)
        right = dim.withColumn(salt, F.explode(every))
    else:
        flags = hot.select(key).withColumn("_hot", F.lit(True))
        left = (
            fact.join(flags, key, "left")
            .withColumn(salt, F.when(F.col("_hot"), spread).otherwise(F.lit(0)))
            .drop("_hot")
        )
        right = (
            dim.join(flags, key, "left")
            .withColumn(salt, F.explode(F.when(F.col("_hot"), every).otherwise(F.array(F.lit(0)))))
            .drop("_hot")
        )
    out = left.join(right, [key, salt], how)
    return out if keep_salt else out.drop(salt)


def salted_agg(
    df: DataFrame,
    keys: Sequence[str],
    salt: str,
    sums: Mapping[str, str],
    distinct: Mapping[str, str] | None = None,
    route: str = "key",
    values: DataFrame | None = None,
) -> DataFrame:
    """Two-phase aggregate: partial by (keys, salt), final by keys.

    ``sums`` maps output -> column (exact decimal sums), ``distinct`` output -> column (one entry).
    ``key``  the distinct column joins the partial key; sizes stay bounded whatever the vocabulary.
    ``set``  a bitmap over the numbered values per partial group, united at the end: a state of bounded size whatever a
             key holds.  ``values`` are the numbered values (see ``states.vocabulary``; found if not given); more of
             them than fit a bitmap take the other route.
    """
    if route not in ("key", "set"):
        raise ValueError(f"unknown route {route!r}")
    parts, finals = [], []
    for out, c in sums.items():
        for i, part in enumerate(sum_parts(c)):
            parts.append(part.alias(f"_{i}_{out}"))
        parts.append(odd_part(c).alias(f"_odd_{out}"))
        total = join_parts(F.sum(f"_0_{out}"), F.sum(f"_1_{out}")).cast("double")
        finals.append(F.coalesce(F.sum(f"_odd_{out}"), total).alias(out))
    if not distinct:
        return df.groupBy(*keys, salt).agg(*parts).groupBy(*keys).agg(*finals)
    ((out, col),) = distinct.items()
    numbered = (values or vocabulary(df, col)) if route == "set" else None
    if numbered is None:
        partial = df.groupBy(*keys, salt, col).agg(*parts)
        return partial.groupBy(*keys).agg(*finals, F.count_distinct(col).alias(out))
    coded = df.join(F.broadcast(numbered), col, "left")
    partial = coded.groupBy(*keys, salt).agg(*parts, F.bitmap_construct_agg("_no").alias("_bits"))
    return partial.groupBy(*keys).agg(*finals, F.bitmap_count(F.bitmap_or_agg("_bits")).alias(out))
