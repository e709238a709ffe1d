"""Reports over arrays, maps and structs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timing import whole_div
from ..functions.values import any_of, major, minor


def array_summary(
    df: DataFrame,
    keys: Sequence[str],
    arr: str,
    distinct: str = "distinct_items",
    total: str = "total_items",
    route: str = "explode",
    row_id: str | None = None,
    chunk: int = 1024,
) -> DataFrame:
    """Distinct items (sorted array) and the number of items per key; empty and NULL arrays count 0.

    ``explode``  one row per item, counted per (key, item) before anything is gathered.
    ``flatten``  arrays of at most ``chunk`` rows (ranges of the unique ``row_id``) are united first, so
                 far fewer items are exploded.  No group is larger than a chunk.
    """
    if route == "explode":
        items = df.select(*keys, F.posexplode_outer(arr).alias("_pos", "_item"))
        counts = items.groupBy(*keys, "_item").agg(F.count("_pos").alias("_n"))
    elif route == "flatten":
        united = df.groupBy(*keys, whole_div(F.col(row_id), F.lit(chunk)).alias("_chunk")).agg(
            F.array_distinct(F.flatten(F.collect_list(arr))).alias("_set"),
            F.sum(F.coalesce(F.size(arr), F.lit(0))).alias("_size"),
        )
        items = united.select(*keys, "_size", F.posexplode_outer("_set").alias("_pos", "_item"))
        first = F.coalesce(F.col("_pos"), F.lit(0)) == 0
        counts = items.groupBy(*keys, "_item").agg(
            F.sum(F.when(first, F.col("_size")).otherwise(F.lit(0))).alias("_n")
        )
    else:
        raise ValueError(f"unknown route {route!r}")
    return counts.groupBy(*keys).agg(
        F.array_sort(F.collect_list("_item")).alias(distinct), F.sum("_n").alias(total)
    )


def map_report(
    df: DataFrame, keys: Sequence[str], props: str, prop: str, value: str, hits: str = "mobile_events"
) -> DataFrame:
    """Per key: events, events with ``prop = value``, distinct property names; NULL and {} bags count.

    One pass over (event, property) rows: an event is counted at its first property, or at the single
    row an empty bag leaves.
    """
    rows = df.select(*keys, F.posexplode_outer(F.map_entries(props)).alias("_pos", "_entry"))
    return rows.groupBy(*keys).agg(
        F.count_if(F.col("_pos").isNull() | (F.col("_pos") == 0)).alias("total_events"),
        F.count_if((F.col("_entry.key") == prop) & (F.col("_entry.value") == value)).alias(hits),
        F.count_distinct(F.col("_entry.key")).alias("distinct_keys"),
    )


def map_rows(df: DataFrame, ids: Sequence[str], props: str) -> DataFrame:
    """One row per property; an event without properties keeps one row of NULLs."""
    return df.select(*ids, F.explode_outer(props).alias("key", "value"))


def struct_profile(
    df: DataFrame,
    keys: Sequence[str],
    field: str,
    members: Sequence[str],
    default: str = "UNKNOWN",
) -> DataFrame:
    """Per key: events, events in ``members``, distinct and most frequent field value.

    Ties go to the smaller value; NULL structs and NULL fields never win.
    """
    counts = df.groupBy(*keys, F.col(field).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    usable = F.col("_v").isNotNull()
    top = F.min(F.when(usable, F.struct((-F.col("_n")).alias("n"), F.col("_v").alias("v"))))
    return counts.groupBy(*keys).agg(
        F.sum("_n").alias("total_events"),
        F.coalesce(F.sum(F.when(any_of("_v", members), F.col("_n"))), F.lit(0).cast("bigint")).alias(
            "mobile_events"
        ),
        F.count_if(usable).alias("distinct_os"),
        F.coalesce(top.getField("v"), F.lit(default)).alias("primary_os"),
    )


def line_summary(
    df: DataFrame, ids: Sequence[str], lines: str, bulk: int = 10, active: str = "ACTIVE"
) -> DataFrame:
    """Summary of an array of line structs (qty, unit_price, status, in_stock) where it lies.

    The filtered array is named once; every measure reads that column.  No shuffle.
    """
    named = df.withColumn("_live", F.filter(lines, lambda x: x["status"] == active))
    total = F.aggregate(
        "_live",
        F.lit(0).cast("bigint"),
        lambda acc, x: acc + x["qty"] * minor(x["unit_price"], 6),
        lambda acc: major(acc, 6),
    )
    return named.select(
        *ids,
        F.coalesce(F.size("_live"), F.lit(0)).alias("n_active"),
        F.coalesce(total, F.lit(0.0)).alias("active_total"),
        F.coalesce(F.exists("_live", lambda x: x["qty"] >= bulk), F.lit(False)).alias("has_bulk"),
        F.coalesce(
            (F.size("_live") > 0) & F.forall("_live", lambda x: x["in_stock"]), F.lit(False)
        ).alias("all_in_stock"),
    )


def line_summary_exploded(
    df: DataFrame, ids: Sequence[str], lines: str, bulk: int = 10, active: str = "ACTIVE"
) -> DataFrame:
    """Route to the same rows through one row per line and conditional aggregates."""
    rows = df.select(*ids, F.explode_outer(lines).alias("_x"))
    live = F.col("_x.status") == active
    return rows.groupBy(*ids).agg(
        F.count_if(live).cast("int").alias("n_active"),
        major(F.coalesce(F.sum(F.when(live, F.col("_x.qty") * minor("_x.unit_price", 6))), F.lit(0)), 6).alias(
            "active_total"
        ),
        F.coalesce(F.bool_or(live & (F.col("_x.qty") >= bulk)), F.lit(False)).alias("has_bulk"),
        F.coalesce(F.bool_and(F.when(live, F.col("_x.in_stock"))), F.lit(False)).alias("all_in_stock"),
    )


def flatten_items(
    df: DataFrame, ids: Sequence[str], struct: str, fields: Sequence[str], items: str, qty: str
) -> DataFrame:
    """Struct fields and one row per item; empty arrays keep a row, negative quantities go."""
    rows = df.select(*ids, *[F.col(f"{struct}.{f}").alias(f) for f in fields], F.explode_outer(items).alias("_i"))
    inner = [f.name for f in df.schema[items].dataType.elementType.fields]
    flat = rows.select(*ids, *fields, *[F.col(f"_i.{n}").alias(n) for n in inner])
    return flat.filter(F.col(qty).isNull() | (F.col(qty) >= 0))


def guarded_forall(arr: str, cond) -> Column:
    """``forall`` that is false on an empty or NULL array."""
    return F.coalesce((F.size(arr) > 0) & F.forall(arr, cond), F.lit(False))
