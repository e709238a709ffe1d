"""Applying a batch of changes to a keyed state.  All of them are safe to replay."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ranking import keep_latest


def apply_changes(
    current: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    cols: Sequence[str],
    at: str,
    op: str = "op",
    delete: str = "D",
    route: str = "union",
) -> DataFrame:
    """State after a CDC batch: per key the latest change, if it is strictly newer than the state.

    A delete is a change like any other: a stale one is ignored, one followed by an insert is undone.
    ``union``  state and changes ranked together: one shuffle, and each task sends one row per key.
    ``outer``  the batch collapsed first, then a full outer join.
    """
    if route == "union":
        last = apply_changes_kept(current.withColumn(op, F.lit("S")), changes, keys, cols, at, op)
        return last.filter(F.col(op) != delete).select(*keys, *cols, at)
    if route == "outer":
        batch = keep_latest(changes.select(*keys, op, *cols, at), keys, [at])
        fields = [op, *cols, at]
        a = current.select(*keys, F.struct(F.lit("S").alias(op), *cols, at).alias("_held"))
        b = batch.select(*keys, F.struct(*fields).alias("_new"))
        newer = F.col("_held").isNull() | (F.col(f"_new.{at}") > F.col(f"_held.{at}"))
        won = F.when(F.col("_new").isNotNull() & newer, F.col("_new")).otherwise(F.col("_held"))
        merged = a.join(b, list(keys), "full_outer").withColumn("_won", won)
        return merged.filter(F.col(f"_won.{op}") != delete).select(
            *keys, *[F.col(f"_won.{c}").alias(c) for c in (*cols, at)]
        )
    raise ValueError(f"unknown route {route!r}")


def apply_changes_kept(
    current: DataFrame, changes: DataFrame, keys: Sequence[str], cols: Sequence[str], at: str, op: str = "op"
) -> DataFrame:
    """The same with tombstones: both sides have ``op``, and a deleted key stays with the time of its deletion."""
    held = current.select(*keys, op, *cols, at, F.lit(1).alias("_held"))
    batch = changes.select(*keys, op, *cols, at, F.lit(0).alias("_held"))
    return keep_latest(held.unionByName(batch), keys, [at, "_held"]).drop("_held")


def latest_of_both(history: DataFrame, delta: DataFrame, keys: Sequence[str], at: str) -> DataFrame:
    """SCD1 snapshot: the latest row per key of the old snapshot and the delta."""
    return keep_latest(history.unionByName(delta), keys, [at])
