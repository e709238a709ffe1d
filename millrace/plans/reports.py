"""Smaller reports over one or two inputs."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.parsing import parse_count, parse_money
from ..functions.timing import day_text
from ..functions.values import count_where, exact_avg, exact_sum, exact_total, major, minor
from ..operators.joins import broadcast_within, enrich, null_safe_join
from ..operators.ranking import keep_latest
from ..operators.rowwise import clean_events, in_range
from ..operators.skew import salted_agg, salted_join
from ..operators.states import vocabulary
from ..operators.timeline import time_delta
from ..sources.layout import write_partitioned
from ..sources.snapshots import snapshot_diff


def daily_activity(raw: DataFrame) -> DataFrame:
    """Users, purchases and revenue per day of cleaned events, in date order."""
    clean = clean_events(raw, "user_id", "event_time", "price")
    return (
        clean.groupBy("event_date")
        .agg(
            F.count_distinct("user_id").alias("dau"),
            count_where(F.col("event_type") == "purchase").alias("purchase_count"),
            exact_sum("price", 2).alias("total_revenue"),
        )
        .orderBy("event_date")
    )


def device_signals(events: DataFrame, devices: DataFrame, rsd: float = 0.05) -> DataFrame:
    """Average signal and approximate event count per device model."""
    return (
        events.join(broadcast_within(devices.select("device_id", "device_model")), "device_id")
        .groupBy("device_model")
        .agg(
            exact_avg("signal_strength").alias("avg_signal"),
            F.approx_count_distinct("event_id", rsd).alias("total_events"),
        )
    )


def best_offers(catalog: DataFrame, offers: DataFrame) -> DataFrame:
    """Per catalog entry: all offers counted, the cheapest with a known price named.

    Offers come down to one row per (sku, variant) before the join.  NULL is a variant.
    """
    known = F.col("price").isNotNull()
    best = F.min(F.when(known, F.struct("price", "seller")))
    per_entry = offers.groupBy("sku", "variant").agg(
        F.count(F.lit(1)).alias("_n"), best.alias("_best")
    )
    found = null_safe_join(catalog, per_entry, ["sku", "variant"], ["variant"])
    return found.select(
        "sku",
        F.coalesce("variant", F.lit("BASE")).alias("variant_label"),
        "product_name",
        F.coalesce("_n", F.lit(0).cast("bigint")).alias("n_offers"),
        F.coalesce("_best.seller", F.lit("NONE")).alias("best_seller"),
        F.col("_best.price").alias("best_price"),
    )


def ingestion_report(raw: DataFrame, money_route: str = "regex") -> DataFrame:
    """Per source: records, bad amounts, net amount, units and average unit price.

    A value that does not parse is NULL, and NULL is the only definition of a bad one.
    """
    parsed = raw.select(
        "source",
        parse_money("amount_raw", money_route).alias("_read"),
        parse_count("units_raw").alias("_units"),
    ).withColumn("_amount", F.nullif("_read", F.lit(float("nan"))))
    net, units = exact_total("_amount"), F.sum("_units")
    return parsed.groupBy("source").agg(
        F.count(F.lit(1)).alias("n_records"),
        count_where(F.col("_amount").isNull()).alias("n_bad_amount"),
        net.cast("double").alias("net_amount"),
        F.coalesce(units, F.lit(0)).alias("total_units"),
        F.round(F.try_divide(net, units), 2).cast("double").alias("avg_unit_price"),
    )


def sensor_daily(readings: DataFrame) -> DataFrame:
    """Average valid reading per sensor type, day and device."""
    valid = in_range(readings, "reading", 0.0, 120.0)
    return valid.groupBy("sensor_type", day_text("timestamp").alias("date"), "device_id").agg(
        exact_avg("reading").alias("avg_reading")
    )


def publish_sensor_daily(readings: DataFrame, path: str, spread: str | None = None, files_per_folder: int = 1) -> None:
    """``spread`` and ``files_per_folder`` cut large folders into several files (see ``write_partitioned``)."""
    write_partitioned(sensor_daily(readings), path, ["sensor_type", "date"], spread, files_per_folder)


def region_revenue(transactions: DataFrame, stores: DataFrame) -> DataFrame:
    """Revenue per region, stores nobody knows under UNKNOWN."""
    placed = enrich(transactions, stores, "store_id", {"region": "UNKNOWN"})
    return placed.groupBy("region").agg(F.sum("amount").alias("revenue"))


def user_journey(clicks: DataFrame, width: timedelta = timedelta(days=1), hot: DataFrame | None = None) -> DataFrame:
    """Each click once, with the seconds since the user's previous one; users in ``hot`` are worked in cells."""
    once = keep_latest(clicks, ["event_id"], ["click_time"])
    deltas = time_delta(once, ["user_id"], "click_time", ["event_id"], "time_diff_sec", width, hot=hot)
    return deltas.select("event_id", "user_id", "click_time", "time_diff_sec")


def salted_customer_summary(
    orders: DataFrame,
    customers: DataFrame,
    n: int = 3,
    hot: DataFrame | None = None,
    route: str = "key",
) -> DataFrame:
    """Amount and distinct products per customer, joined and aggregated over salts."""
    joined = salted_join(orders, customers, "customer_id", "order_id", n, hot=hot, keep_salt="salt")
    out = salted_agg(
        joined,
        ["customer_id", "segment"],
        "salt",
        {"total_amount": "amount"},
        {"n_products": "product"},
        route=route,
        # Numbered before the join, where the column alone is read.
        values=vocabulary(orders, "product") if route == "set" else None,
    )
    return out.select("customer_id", "segment", "total_amount", "n_products")


def price_audit(latest: DataFrame, original: DataFrame) -> DataFrame:
    """Products whose price differs between two versions of the table."""
    changed = snapshot_diff(latest, original, ["product_id"], ["price"])
    return changed.select(
        "product_id",
        "current_price",
        "original_price",
        major(minor("current_price", 6) - minor("original_price", 6), 6).alias("price_diff"),
    )
