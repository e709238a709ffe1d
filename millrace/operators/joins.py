"""Equi-joins with exact NULL, default-member and existence semantics.

No operator forces a broadcast.  Catalyst broadcasts a side whose estimated size is below
``spark.sql.autoBroadcastJoinThreshold``; AQE decides again on measured sizes and splits skewed
partitions of the sort-merge joins that remain.  ``broadcast_within`` adds a hint only behind a bound.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .skew import crowded, flag_keys


def _within(dim: DataFrame, max_rows: int, max_bytes: int) -> bool:
    """Looks at no more than ``max_rows + 1`` rows; bytes are those of the rows written out."""
    width = F.octet_length(F.to_json(F.struct("*")))
    n, size = dim.limit(max_rows + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
    return n <= max_rows and size <= max_bytes


def broadcast_within(dim: DataFrame, max_rows: int = 100_000, max_bytes: int = 64 << 20) -> DataFrame:
    """Hint a broadcast only after measuring that the side has at most ``max_rows`` rows and ``max_bytes``.

    A larger side is returned without a hint, so the join falls back to a shuffle that AQE can balance.
    """
    return F.broadcast(dim) if _within(dim, max_rows, max_bytes) else dim


def broadcast_hint(dim: DataFrame, alias: str, max_rows: int = 100_000, max_bytes: int = 64 << 20) -> str:
    """The SQL hint for a relation's alias, or nothing if the relation is not within the bounds."""
    return f"/*+ BROADCAST({alias}) */" if _within(dim, max_rows, max_bytes) else ""


def enrich(
    fact: DataFrame, dim: DataFrame, on: str | Sequence[str], defaults: Mapping[str, object]
) -> DataFrame:
    """Left lookup: every fact survives, a miss (or a NULL attribute) takes the default member.

    ``defaults`` names the attributes to read from ``dim``; a None default leaves NULL.
    """
    keys = [on] if isinstance(on, str) else list(on)
    found = fact.join(dim.select(*keys, *defaults), keys, "left")
    fills = {c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items() if v is not None}
    return found.withColumns(fills) if fills else found


def keep_if_exists(left: DataFrame, right: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows with at least one match; a row never multiplies."""
    return left.join(right, on, "left_semi")


def drop_if_exists(left: DataFrame, right: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows without a match; NULL keys on either side match nothing, so they are kept."""
    return left.join(right, on, "left_anti")


def not_in(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """SQL ``NOT IN``: one NULL in the list, or a NULL probe against a non-empty list, yields nothing.

    Kept for parity; it needs the whole list on every executor.  ``drop_if_exists`` is the default.
    """
    return left.sparkSession.sql(
        f"SELECT * FROM {{l}} WHERE {left_key} NOT IN (SELECT {right_key} FROM {{r}})", l=left, r=right
    )


def not_in_by_counts(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """The same three-valued result without the null-aware join: anti join plus one-row facts.

    The list is summed up in one row (how many values, how many NULLs), so nothing but that row
    travels to every task.
    """
    facts = right.agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(F.col(right_key).isNull()).alias("_nulls")
    )
    n, nulls = facts.first()
    if n == 0:
        return left
    if nulls:
        return left.limit(0)
    known = right.select(F.col(right_key).alias(left_key))
    return left.filter(F.col(left_key).isNotNull()).join(known, left_key, "left_anti")


def null_safe_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    nullable: Sequence[str],
    how: str = "left",
) -> DataFrame:
    """Join in which NULL is a key value like any other for the ``nullable`` keys.

    The left side's key columns are kept.
    """
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    cond = reduce(
        lambda a, b: a & b,
        [
            left[k].eqNullSafe(renamed[f"_r_{k}"]) if k in nullable else left[k] == renamed[f"_r_{k}"]
            for k in keys
        ],
    )
    return left.join(renamed, cond, how).drop(*[f"_r_{k}" for k in keys])


def sentinel_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    nullable: str,
    sentinel: object,
    how: str = "left",
) -> DataFrame:
    """Null-safe join on a filled copy of the nullable key: plain equality, reusable partitioning.

    The sentinel must be a value the key never takes; the copy never leaves the operator.
    """
    rest = [k for k in keys if k != nullable]
    a = left.withColumn("_filled", F.coalesce(F.col(nullable), F.lit(sentinel)))
    b = right.withColumn("_filled", F.coalesce(F.col(nullable), F.lit(sentinel))).drop(nullable)
    return a.join(b, [*rest, "_filled"], how).drop("_filled")


def join_spread(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    max_rows: int | None = None,
    n: int = 64,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Equi-join for a right side that is itself an aggregate or a window result.

    AQE splits a skewed join only where both sides come straight out of a shuffle; below an aggregate it
    cannot.  The keys in ``hot`` (or, with ``max_rows``, those that a census of the left side finds to have
    more rows), and only those, are spread over n salts taken from the row's own values, with their right
    rows repeated.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"{how!r} would show repeated right rows")
    keys = list(keys)
    if hot is None and max_rows is not None:
        hot = crowded(left, keys, max_rows)
    if hot is None:
        return left.join(right, keys, how)
    plain = [c for c, kind in left.dtypes if "map<" not in kind and kind != "variant"]
    spread = F.pmod(F.xxhash64(*plain), F.lit(n)).cast("int")
    a = flag_keys(left, hot, keys, "_hot").withColumn(
        "_salt", F.when(F.col("_hot"), spread).otherwise(F.lit(0))
    )
    every = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(n - 1))).otherwise(F.array(F.lit(0)))
    b = flag_keys(right, hot, keys, "_hot").withColumn("_salt", F.explode(every))
    return a.drop("_hot").join(b.drop("_hot"), [*keys, "_salt"], how).drop("_salt")


def lookup_chain(fact: DataFrame, hops: Sequence[tuple[DataFrame, str, Sequence[str]]]) -> DataFrame:
    """Follow fact -> dim -> config.  Each hop is ``(table, key, columns to take)``.

    Test the outcome on a column of the last hop: a hit on an earlier one proves nothing.
    """
    out = fact
    for dim, key, take in hops:
        out = out.join(dim.select(key, *take), key, "left")
    return out


def rollup_then_join(
    fact: DataFrame,
    many: DataFrame,
    key: str | Sequence[str],
    aggs: Mapping[str, Column],
    max_rows: int | None = None,
) -> DataFrame:
    """Bring the many side to one row per key first, so the join cannot fan out.

    Give ``max_rows`` where one key may hold very many facts (see ``join_spread``).
    """
    keys = [key] if isinstance(key, str) else list(key)
    one = many.groupBy(*keys).agg(*[e.alias(name) for name, e in aggs.items()])
    if max_rows is None:
        return fact.join(one, keys, "left")
    return join_spread(fact, one, keys, "left", max_rows)


def split_complement(all_rows: DataFrame, published: DataFrame, key: str, status: str) -> DataFrame:
    """Published rows and all the others, each row once.

    ``key`` must not be NULL and ``published`` carries the same columns.
    """
    rest = all_rows.join(published.select(key), key, "left_anti")
    return published.withColumn(status, F.lit("PUBLISHED")).unionByName(
        rest.withColumn(status, F.lit("PENDING"))
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once: a join on them would fan out."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def spine(keys: DataFrame, first: object, last: object, day: str = "d") -> DataFrame:
    """Every key on every date of a closed range.  Rows are generated in place, nothing is joined."""
    days = F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))
    return keys.withColumn(day, F.explode(days))


def merge_states(
    old: DataFrame, new: DataFrame, keys: Sequence[str], cols: Sequence[str], flag: str = "origin"
) -> DataFrame:
    """Full outer merge of a state with its changes, the new values winning key by key.

    ``flag`` says where the key was seen: ``old``, ``new`` or ``both``.
    """
    a = old.select(*keys, F.struct(*cols).alias("_old"))
    b = new.select(*keys, F.struct(*cols).alias("_new"))
    origin = (
        F.when(F.col("_new").isNull(), F.lit("old"))
        .when(F.col("_old").isNull(), F.lit("new"))
        .otherwise(F.lit("both"))
    )
    won = F.coalesce(F.col("_new"), F.col("_old"))
    return a.join(b, list(keys), "full_outer").select(
        *keys, *[won.getField(c).alias(c) for c in cols], origin.alias(flag)
    )
