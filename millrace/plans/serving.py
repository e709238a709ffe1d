"""Aggregates and dimensions that consumers read."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timing import day_text, local_time, stamp_text, utc_of_local_midnight
from ..functions.values import between_days, count_where, exact_sum, exact_total, minor, pct_change
from ..operators.intervals import interval_join
from ..operators.joins import drop_if_exists, keep_if_exists, rollup_then_join, spine
from ..operators.quality import DOUBLE_NOISE, Gates, counted, measure, publish
from ..operators.ranking import keep_latest_counted
from ..operators.timeline import trailing_avg, value_at_offset, versions
from ..operators.upserts import apply_changes, latest_of_both

# Names, order and types of the published columns.
SUBSCRIPTION = "subscription_id string, plan string, status string, mrr double, updated_at string"
REGION_DAILY = (
    "order_date string, region string, n_orders bigint, gross_gmv double, "
    "refund_amount double, net_gmv double"
)
CAMPAIGN_DAILY = (
    "campaign_id string, market_code string, local_date string, n_impressions bigint, "
    "n_clicks bigint, spend_usd double"
)


def subscriptions(
    current: DataFrame, changes: DataFrame, catalog: DataFrame, route: str = "union"
) -> DataFrame:
    """Subscription dimension after a CDC batch, every price taken from the catalog."""
    state = apply_changes(
        current,
        changes.withColumnRenamed("change_ts", "updated_at"),
        ["subscription_id"],
        ["plan", "status"],
        "updated_at",
        route=route,
    )
    priced = state.join(catalog.select("plan", "mrr"), "plan", "left")
    out = priced.select("subscription_id", "plan", "status", "mrr", "updated_at")
    gates = Gates(
        unique=["subscription_id"], not_null=["subscription_id", "plan", "mrr"], ddl=SUBSCRIPTION
    )
    return publish(out, gates, "subscription")


def customer_snapshot(history: DataFrame, delta: DataFrame) -> DataFrame:
    """SCD1 customer snapshot: the latest row wins."""
    return latest_of_both(history, delta, ["customer_id"], "updated_at")


def product_history(feed: DataFrame, width: timedelta = timedelta(days=365)) -> DataFrame:
    """SCD2 history of category and price."""
    return versions(feed, ["product_id"], "changed_at", ["category", "price"], width=width).select(
        "product_id", "effective_from", "effective_to", "category", "price", "is_current"
    )


def current_catalog(updates: DataFrame) -> DataFrame:
    """Last update per product and how many updates it ever had."""
    kept = keep_latest_counted(updates, ["product_id"], ["updated_at", "source_seq"])
    return kept.select("product_id", "product_name", "price", "updated_at", "n_versions")


def region_daily(
    orders: DataFrame,
    seller_region: DataFrame,
    refunds: DataFrame,
    resolve: str = "repair",
    direct: bool = False,
) -> DataFrame:
    """Gross and net GMV per order date and region of the assignment in effect that day.

    Refunds are brought to one row per order before they meet the orders, and count on the order's date.
    """
    live = orders.filter(F.col("status") != "CANCELLED").select(
        "order_id",
        "seller_id",
        "order_date",
        (F.col("qty") * F.col("unit_price")).alias("_gross"),
    )
    live, before = counted(live, {"orders": F.count(F.lit(1)), "gross": exact_total("_gross")})
    placed = interval_join(
        live,
        seller_region.select("seller_id", "region", "valid_from", "valid_to"),
        ["seller_id"],
        "order_date",
        "valid_from",
        "valid_to",
        {"region": "UNKNOWN"},
        resolve=resolve,
        fact_key=["order_id"],
        direct=direct,
    )
    netted = rollup_then_join(
        placed, refunds, "order_id", {"_refund": exact_sum("refund_amount")}
    )
    gross = exact_total("_gross")
    refund = F.coalesce(exact_total("_refund"), F.lit(0))
    out = netted.groupBy("order_date", "region").agg(
        F.count_distinct("order_id").alias("n_orders"),
        gross.cast("double").alias("gross_gmv"),
        refund.cast("double").alias("refund_amount"),
        (gross - refund).cast("double").alias("net_gmv"),
    )
    gates = Gates(
        unique=["order_date", "region"],
        not_null=["order_date", "region"],
        totals={
            "orders": (F.coalesce(F.sum("n_orders"), F.lit(0)), lambda: before("orders")),
            "gross": (exact_total("gross_gmv"), lambda: before("gross"), DOUBLE_NOISE),
        },
        ddl=REGION_DAILY,
    )
    return publish(out, gates, "region_daily")


def campaign_daily(
    events: DataFrame,
    placements: DataFrame,
    markets: DataFrame,
    flights: DataFrame,
    route: str = "local",
) -> DataFrame:
    """Delivery per campaign, market and market-local day, inside the flight the advertiser bought.

    ``local``  the flight test on the local date, both ends inclusive.
    ``utc``    the same flight as a half-open UTC range per (campaign, market), tested on the raw
               timestamp; the earliest and latest bound, as literals of the column's own type, reach
               the scan as pushed filters.
    """
    zones = placements.select("placement_id", "market_code").join(
        markets.select("market_code", "tz_name"), "market_code"
    )
    slim = events.select("campaign_id", "placement_id", "event_type", "event_ts_utc", "spend_usd")
    at = F.col("event_ts_utc").cast("timestamp")
    local_day = F.to_date(local_time(at, "tz_name"))
    flight = flights.select(
        "campaign_id",
        "market_code",
        F.col("flight_start_date").cast("date").alias("_first"),
        F.col("flight_end_date").cast("date").alias("_last"),
    )
    if route == "local":
        placed = slim.join(zones, "placement_id").join(flight, ["campaign_id", "market_code"])
        scoped = placed.withColumn("_day", local_day).filter(
            between_days(F.col("_day"), F.col("_first"), F.col("_last"))
        )
    elif route == "utc":
        bounded = flight.join(markets.select("market_code", "tz_name"), "market_code").select(
            "campaign_id",
            "market_code",
            utc_of_local_midnight("_first", "tz_name").alias("_lo"),
            utc_of_local_midnight("_last", "tz_name", 1).alias("_hi"),
        )
        edges = measure(
            bounded,
            {"lo": stamp_text(F.min("_lo")), "hi": stamp_text(F.max("_hi"))},
        )
        kind = dict(events.dtypes)["event_ts_utc"]
        raw = F.col("event_ts_utc")
        near = slim.filter(
            (raw >= F.lit(edges["lo"]).cast(kind)) & (raw < F.lit(edges["hi"]).cast(kind))
        )
        placed = near.join(zones, "placement_id").join(bounded, ["campaign_id", "market_code"])
        scoped = placed.filter((at >= F.col("_lo")) & (at < F.col("_hi"))).withColumn("_day", local_day)
    else:
        raise ValueError(f"unknown route {route!r}")
    out = scoped.groupBy("campaign_id", "market_code", day_text("_day").alias("local_date")).agg(
        count_where(F.col("event_type") == "IMPRESSION").alias("n_impressions"),
        count_where(F.col("event_type") == "CLICK").alias("n_clicks"),
        exact_sum("spend_usd").alias("spend_usd"),
    )
    gates = Gates(
        unique=["campaign_id", "market_code", "local_date"],
        not_null=["campaign_id", "market_code", "local_date"],
        ddl=CAMPAIGN_DAILY,
    )
    return publish(out, gates, "campaign_daily")


def dense_store_report(sales: DataFrame, stores: DataFrame, first: date, last: date) -> DataFrame:
    """Revenue per store and store-local day; every store shows every day, empty days with zero."""
    day = F.to_date(local_time("ts_utc", "tz"))
    daily = (
        sales.select("store_id", "ts_utc", "amount")
        .join(stores.select("store_id", "tz"), "store_id")
        .withColumn("d", day)
        .filter(F.col("d").between(F.lit(first), F.lit(last)))
        .groupBy("store_id", "d")
        .agg(exact_sum("amount").alias("revenue"), F.count(F.lit(1)).alias("n_txn"))
    )
    full = spine(stores.select("store_id"), first, last).join(daily, ["store_id", "d"], "left")
    return full.select(
        "store_id",
        "d",
        F.coalesce("revenue", F.lit(0.0)).alias("revenue"),
        F.coalesce("n_txn", F.lit(0).cast("bigint")).alias("n_txn"),
    )


def store_trend(daily: DataFrame) -> DataFrame:
    """Per store and trading day: 7-day average, the day before, and growth against it."""
    keys = ["store_id"]
    averaged = trailing_avg(daily, keys, "sale_date", "revenue", 7, "ma7")
    seen = value_at_offset(averaged, keys, "sale_date", "revenue", -1, "prev_day_revenue")
    growth = pct_change(minor("revenue", 6), minor("prev_day_revenue", 6))
    return seen.withColumn("dod_growth_pct", growth).select(
        "store_id", "sale_date", "revenue", "ma7", "prev_day_revenue", "dod_growth_pct"
    )


def outreach_list(customers: DataFrame, orders: DataFrame, complaints: DataFrame) -> DataFrame:
    """Customers with an order and without a complaint; complaints about nobody change nothing."""
    buyers = keep_if_exists(customers, orders.select("cust_id"), "cust_id")
    return drop_if_exists(buyers, complaints.select("cust_id"), "cust_id")
