"""Complete jobs on hand-made rows: the result, a rerun, empty input, and gates that fire."""

from datetime import date, timedelta

import pytest
from helpers import day, rows, same, ts
from pyspark.sql import functions as F

from millrace.operators.quality import GateError, same_rows
from millrace.plans import facts, reports, serving
from millrace.workload.catalog import QUERIES

# ---------------------------------------------------------------- sessions

EVENTS = "event_id string, device_id string, event_ts string, event_name string"
SESSION_ROWS = [
    ("a1", "m1", "2025-07-31 23:40:00", "open"),
    ("a2", "m1", "2025-07-31 23:55:00", "push"),
    ("a3", "m1", "2025-08-01 00:10:00", "view"),
    ("a4", "m1", "2025-08-01 00:40:01", "view"),
    ("b1", "m2", "2025-08-01 09:00:00", "push"),
    ("c1", "m3", "2025-08-01 10:00:00", "open"),
    ("c2", "m3", "2025-08-01 10:30:00", "open"),
]


def session_inputs(spark, data=SESSION_ROWS):
    events = spark.createDataFrame(data, EVENTS)
    names = [("open", True, "x"), ("view", True, "x"), ("view", True, "y"), ("push", False, "x"), ("rare", True, "x")]
    catalog = spark.createDataFrame(names, "event_name string, is_engagement boolean, owner_team string")
    devices = spark.createDataFrame([("m1", "iOS", "t"), ("m9", "Web", "t")], "device_id string, platform string, push_token string")
    return events, catalog, devices


def test_app_sessions(spark):
    want = [
        ("m1-20250731234000", "m1", "iOS", "2025-07-31", "2025-07-31 23:40:00", "2025-08-01 00:10:00", 2, 1800),
        ("m1-20250801004001", "m1", "iOS", "2025-08-01", "2025-08-01 00:40:01", "2025-08-01 00:40:01", 1, 0),
        ("m3-20250801100000", "m3", "UNKNOWN", "2025-08-01", "2025-08-01 10:00:00", "2025-08-01 10:30:00", 2, 1800),
    ]
    got = facts.app_sessions(*session_inputs(spark))
    same(got, want, facts.APP_SESSION)
    assert same_rows(got, facts.app_sessions(*session_inputs(spark, SESSION_ROWS[::-1])))
    assert facts.app_sessions(*session_inputs(spark, [])).count() == 0


def test_app_sessions_gate_fires_on_a_fanning_registry(spark):
    events, catalog, devices = session_inputs(spark)
    with pytest.raises(GateError, match="unique.*engagement events"):
        facts.app_sessions(events, catalog, devices.union(devices))


# ---------------------------------------------------------------- telemetry


def test_device_hours(spark):
    sent = [
        ("e1", "d1", "2025-05-05 08:10:00", 20.0, "2025-05-05 08:11:00"),
        ("e2", "d1", "2025-05-05 08:50:00", 21.0, "2025-05-05 08:51:00"),
        ("e7", "d1", "2025-05-05 08:50:00", 25.0, "2025-05-05 09:40:00"),
        ("e2", "d1", "2025-05-05 08:50:00", 21.0, "2025-05-05 08:51:00"),
        ("e3", "d1", "2025-05-05 09:30:00", 30.0, "2025-05-05 09:31:00"),
        ("e4", "d2", "2025-05-05 09:30:00", 10.0, "2025-05-05 09:31:00"),
        ("e5", "d3", "2025-05-05 09:30:00", 11.0, "2025-05-05 09:31:00"),
        ("e6", "zz", "2025-05-05 09:30:00", 12.0, "2025-05-05 09:31:00"),
    ]
    readings = spark.createDataFrame(sent, "event_id string, device_id string, reading_ts string, temp_c double, ingest_ts string")
    registry = spark.createDataFrame(
        [("d1", "S1", "m", "2025-01-01", None), ("d2", "S2", "m", "2025-01-01", "2025-05-05"), ("d3", "S3", "m", "2025-05-05", None)],
        "device_id string, site_id string, model string, installed_on string, decommissioned_on string",
    )
    windows = spark.createDataFrame(
        [("t1", "d1", "2025-05-05 09:00:00", "2025-05-05 09:31:00"), ("t2", "d1", "2025-05-04 00:00:00", "2025-05-05 08:10:00"), ("t3", "d2", "2025-05-05 00:00:00", "2025-05-06 00:00:00")],
        "ticket_id string, device_id string, window_start string, window_end string",
    )
    want = [("d1", "2025-05-05 08:00:00", "S1", 2, 22.5, 25.0), ("d3", "2025-05-05 09:00:00", "S3", 1, 11.0, 11.0)]
    same(facts.device_hours(readings, registry, windows), want, facts.DEVICE_HOUR)
    assert facts.device_hours(readings.limit(0), registry, windows).count() == 0
    blank = registry.withColumn("site_id", F.when(F.col("device_id") != "d1", F.col("site_id")))
    with pytest.raises(GateError, match="not null site_id"):
        facts.device_hours(readings, blank, windows)


# ---------------------------------------------------------------- campaigns


def campaign_inputs(spark):
    seen = [
        ("1", "K1", "pj", "IMPRESSION", "2025-09-09 15:30:00", 4.0),
        ("2", "K1", "pj", "CLICK", "2025-09-10 02:00:00", 0.0),
        ("3", "K1", "pj", "IMPRESSION", "2025-09-11 15:00:00", 9.0),
        ("4", "K1", "pj", "IMPRESSION", "2025-09-11 14:59:59", 1.0),
        ("5", "K1", "pu", "CLICK", "2025-09-10 06:30:00", 0.5),
        ("6", "K2", "pj", "IMPRESSION", "2025-09-10 03:00:00", 7.0),
    ]
    events = spark.createDataFrame(seen, "event_id string, campaign_id string, placement_id string, event_type string, event_ts_utc string, spend_usd double")
    placements = spark.createDataFrame([("pj", "JP", "v"), ("pu", "US", "v")], "placement_id string, market_code string, channel string")
    markets = spark.createDataFrame([("JP", "Asia/Tokyo", "JPY"), ("US", "America/Los_Angeles", "USD")], "market_code string, tz_name string, reporting_currency string")
    flights = spark.createDataFrame(
        [("K1", "JP", "2025-09-10", "2025-09-11"), ("K1", "US", "2025-09-09", "2025-09-09"), ("K2", "US", "2025-09-01", "2025-09-30")],
        "campaign_id string, market_code string, flight_start_date string, flight_end_date string",
    )
    return events, placements, markets, flights


@pytest.mark.parametrize("route", ["local", "utc"])
def test_campaign_daily(spark, route):
    want = [
        ("K1", "JP", "2025-09-10", 1, 1, 4.0),
        ("K1", "JP", "2025-09-11", 1, 0, 1.0),
        ("K1", "US", "2025-09-09", 0, 1, 0.5),
    ]
    inputs = campaign_inputs(spark)
    same(serving.campaign_daily(*inputs, route=route), want, serving.CAMPAIGN_DAILY)
    assert serving.campaign_daily(inputs[0].limit(0), *inputs[1:], route=route).count() == 0
    assert serving.campaign_daily(*inputs[:3], inputs[3].limit(0), route=route).count() == 0
    twice = inputs[1].union(inputs[1])
    assert serving.campaign_daily(inputs[0], twice, *inputs[2:], route=route).count() == 3


# ---------------------------------------------------------------- regional revenue


def region_inputs(spark):
    sold = [
        ("o1", "s1", "2025-06-10", 2, 50.0, "DONE"),
        ("o2", "s1", "2025-06-10", 1, 10.5, "DONE"),
        ("o3", "s2", "2025-06-10", 1, 20.0, "SHIPPED"),
        ("o4", "s2", "2025-05-10", 3, 1.0, "DONE"),
        ("o5", "s3", "2025-06-10", 1, 7.0, "DONE"),
        ("o6", "s1", "2025-06-10", 1, 999.0, "CANCELLED"),
        ("o7", "s9", "2025-06-11", 1, 8.0, "DONE"),
    ]
    orders = spark.createDataFrame(sold, "order_id string, seller_id string, order_date string, qty int, unit_price double, status string")
    spans = [
        ("s1", "NORTH", "w", "2025-01-01", "2025-06-10"),
        ("s1", "SOUTH", "w", "2025-06-10", None),
        ("s2", "EAST", "w", "2025-01-01", None),
        ("s2", "WEST", "w", "2025-06-01", "2025-06-05"),
        ("s3", "LATE", "w", "2025-07-01", None),
    ]
    regions = spark.createDataFrame(spans, "seller_id string, region string, warehouse string, valid_from string, valid_to string")
    back = [("r1", "o1", 5.0, "2025-06-20"), ("r2", "o1", 6.0, "2025-06-21"), ("r3", "o6", 999.0, "2025-06-21")]
    refunds = spark.createDataFrame(back, "refund_id string, order_id string, refund_amount double, refund_date string")
    return orders, regions, refunds


@pytest.mark.parametrize("resolve,after", [("repair", "UNKNOWN"), ("rank", "EAST")])
def test_region_daily(spark, resolve, after):
    want = [
        ("2025-05-10", "EAST", 1, 3.0, 0.0, 3.0),
        ("2025-06-10", "SOUTH", 2, 110.5, 11.0, 99.5),
        ("2025-06-11", "UNKNOWN", 1, 8.0, 0.0, 8.0),
    ]
    if after == "UNKNOWN":
        want.append(("2025-06-10", "UNKNOWN", 2, 27.0, 0.0, 27.0))
    else:
        want += [("2025-06-10", "UNKNOWN", 1, 7.0, 0.0, 7.0), ("2025-06-10", "EAST", 1, 20.0, 0.0, 20.0)]
    inputs = region_inputs(spark)
    same(serving.region_daily(*inputs, resolve=resolve), want, serving.REGION_DAILY)
    assert serving.region_daily(inputs[0].limit(0), *inputs[1:], resolve=resolve).count() == 0


def test_region_daily_gate_fires_on_a_repeated_order(spark):
    orders, regions, refunds = region_inputs(spark)
    with pytest.raises(GateError, match="orders"):
        serving.region_daily(orders.union(orders.filter("order_id = 'o1'")), regions, refunds)


# ---------------------------------------------------------------- staging

REQUEST = "request_id string, store_code string, sku string, pack_code string, qty_cases int"


def staging_inputs(spark, extra=()):
    asked = [
        ("q1", " st1", "sku-1", "box ", 2),
        ("q2", "ST1", "SKU-2", None, 3),
        ("q3", "ST7", "SKU-7", "BOX", 1),
        ("q4", "ST1", "SKU-7", "BOX", 1),
        ("q5", "ST1", "SKU-3", None, 1),
        *extra,
    ]
    return (
        spark.createDataFrame(asked, REQUEST),
        spark.createDataFrame([("ST1", "DC-A", "n")], "store_code string, dc_code string, store_name string"),
        spark.createDataFrame([("SKU-1", "ACTIVE", "b"), ("SKU-2", "ACTIVE", "b"), ("SKU-3", "DISCONTINUED", "b")], "sku string, sku_status string, buyer_id string"),
        spark.createDataFrame([("SKU-1", "BOX", 6), ("SKU-1", "BAG", 9), ("SKU-2", None, 12), ("SKU-3", None, 10)], "sku string, pack_code string, units_per_case int"),
    )


def test_staged_requests(spark):
    want = [
        ("q1", "ST1", "SKU-1", "BOX", "DC-A", 12, "ACCEPTED", None),
        ("q2", "ST1", "SKU-2", None, "DC-A", 36, "ACCEPTED", None),
        ("q3", "ST7", "SKU-7", "BOX", None, None, "QUARANTINED", "UNKNOWN_STORE"),
        ("q4", "ST1", "SKU-7", "BOX", None, None, "QUARANTINED", "UNKNOWN_SKU"),
        ("q5", "ST1", "SKU-3", None, None, None, "QUARANTINED", "DISCONTINUED_SKU"),
    ]
    same(facts.staged_requests(*staging_inputs(spark)), want, facts.STAGED_REQUEST)
    requests, *dims = staging_inputs(spark)
    assert facts.staged_requests(requests.limit(0), *dims).count() == 0


def test_staging_gates_fire(spark):
    with pytest.raises(GateError, match="accepted without payload"):
        facts.staged_requests(*staging_inputs(spark, [("q9", "ST1", "SKU-1", "TUB", 1)]))
    requests, stores, skus, packs = staging_inputs(spark)
    with pytest.raises(GateError, match="unique.*requests"):
        facts.staged_requests(requests, stores.union(stores), skus, packs)


# ---------------------------------------------------------------- payouts

TRIP = "trip_id string, driver_id string, completed_ts string, fare_cents bigint, {} string"


def payout_inputs(spark):
    landed = [("t1", "a", "2025-10-01 08:00:00", 1000, "2025-10-02"), ("t2", "b", "2025-10-01 23:59:59", 500, "2025-10-02"), ("t3", "c", "2025-10-02 01:00:00", 700, "2025-10-02"), ("t4", "x", "2025-10-02 01:00:00", 900, "2025-10-02"), ("t5", "d", "2025-10-02 01:00:00", 100, "2025-10-02")]
    held = [("t0", "a", "2025-09-28 10:00:00", 2000, "2025-09-29")]
    drivers = [("a", "f1"), ("b", "f9"), ("c", None), ("d", "f2")]
    return (
        spark.createDataFrame(landed, TRIP.format("landing_date")),
        spark.createDataFrame(held, TRIP.format("first_seen_date")),
        spark.createDataFrame(drivers, "driver_id string, fleet_id string"),
        spark.createDataFrame([("f1", 15), ("f2", None)], "fleet_id string, commission_pct int"),
    )


def test_trip_payouts(spark):
    want = [
        ("t0", "a", "f1", "2025-09-28", 2000, 1700, "2025-09-29", "PUBLISHED"),
        ("t1", "a", "f1", "2025-10-01", 1000, 850, "2025-10-02", "PUBLISHED"),
        ("t2", "b", "f9", "2025-10-01", 500, None, "2025-10-02", "PENDING"),
        ("t3", "c", None, "2025-10-02", 700, None, "2025-10-02", "PENDING"),
        ("t4", "x", None, "2025-10-02", 900, None, "2025-10-02", "PENDING"),
        ("t5", "d", "f2", "2025-10-02", 100, None, "2025-10-02", "PENDING"),
    ]
    landed, held, drivers, commissions = payout_inputs(spark)
    same(facts.trip_payouts(landed, held, drivers, commissions), want, facts.TRIP_PAYOUT)
    quiet = facts.trip_payouts(landed.limit(0), held, drivers, commissions)
    assert rows(quiet) == [want[0]]
    assert facts.trip_payouts(landed.limit(0), held.limit(0), drivers, commissions).count() == 0


def test_payout_gate_fires_on_a_repeated_driver(spark):
    landed, held, drivers, commissions = payout_inputs(spark)
    with pytest.raises(GateError, match="unique.*candidates"):
        facts.trip_payouts(landed, held, drivers.union(drivers), commissions)


# ---------------------------------------------------------------- upserts

STATE = "subscription_id string, plan string, status string, mrr double, updated_at string"
CHANGE = "subscription_id string, op string, plan string, status string, mrr double, change_ts string"


def subscription_inputs(spark):
    held = [(f"s{i}", "BASIC", "ACTIVE", 1.0, "2025-08-10 00:00:00") for i in range(1, 8)]
    batch = [
        ("s1", "U", "PRO", "ACTIVE", 55.0, "2025-08-11 00:00:00"),
        ("s2", "U", "PRO", "ACTIVE", 30.0, "2025-08-09 00:00:00"),
        ("s3", "D", None, None, None, "2025-08-11 00:00:00"),
        ("s4", "D", None, None, None, "2025-08-09 00:00:00"),
        ("s5", "U", "BASIC", "PAUSED", 1.0, "2025-08-11 00:00:00"),
        ("s5", "U", "PRO", "ACTIVE", 1.0, "2025-08-12 00:00:00"),
        ("s6", "D", None, None, None, "2025-08-11 00:00:00"),
        ("s6", "I", "PRO", "ACTIVE", 1.0, "2025-08-12 00:00:00"),
        ("s7", "U", "PRO", "ACTIVE", 1.0, "2025-08-10 00:00:00"),
        ("s8", "I", "PRO", "ACTIVE", 1.0, "2025-08-01 00:00:00"),
        ("s9", "D", None, None, None, "2025-08-11 00:00:00"),
    ]
    catalog = spark.createDataFrame([("BASIC", 10.0), ("PRO", 30.0)], "plan string, mrr double")
    return spark.createDataFrame(held, STATE), spark.createDataFrame(batch, CHANGE), catalog


@pytest.mark.parametrize("route", ["union", "outer"])
def test_subscriptions(spark, route):
    want = [
        ("s1", "PRO", "ACTIVE", 30.0, "2025-08-11 00:00:00"),
        ("s2", "BASIC", "ACTIVE", 10.0, "2025-08-10 00:00:00"),
        ("s4", "BASIC", "ACTIVE", 10.0, "2025-08-10 00:00:00"),
        ("s5", "PRO", "ACTIVE", 30.0, "2025-08-12 00:00:00"),
        ("s6", "PRO", "ACTIVE", 30.0, "2025-08-12 00:00:00"),
        ("s7", "BASIC", "ACTIVE", 10.0, "2025-08-10 00:00:00"),
        ("s8", "PRO", "ACTIVE", 30.0, "2025-08-01 00:00:00"),
    ]
    current, changes, catalog = subscription_inputs(spark)
    got = serving.subscriptions(current, changes, catalog, route)
    same(got, want, STATE)
    replayed = serving.subscriptions(got, changes.filter("op <> 'D'"), catalog, route)
    assert same_rows(replayed, got)
    assert serving.subscriptions(current, changes.limit(0), catalog, route).count() == 7


def test_subscription_gate_fires_without_a_price(spark):
    current, changes, catalog = subscription_inputs(spark)
    with pytest.raises(GateError, match="not null mrr"):
        serving.subscriptions(current, changes, catalog.filter("plan = 'PRO'"))


def test_customer_snapshot(spark):
    ddl = "customer_id string, email string, tier string, updated_at timestamp_ntz"
    old = spark.createDataFrame([("1", "a", "x", ts("2025-01-01")), ("2", "b", "x", ts("2025-01-01"))], ddl)
    new = spark.createDataFrame([("1", "c", "y", ts("2025-02-01")), ("3", "d", "x", ts("2024-02-01"))], ddl)
    want = [("1", "c", "y", ts("2025-02-01")), ("2", "b", "x", ts("2025-01-01")), ("3", "d", "x", ts("2024-02-01"))]
    got = serving.customer_snapshot(old, new)
    same(got, want, ddl)
    assert same_rows(serving.customer_snapshot(got, new), got)


def test_product_history_and_catalog(spark):
    feed = [("p", day("2025-01-04"), "c", 40.0), ("p", day("2025-01-01"), "c", 40.0), ("p", day("2025-01-09"), "c", 45.0)]
    got = serving.product_history(spark.createDataFrame(feed, "product_id string, changed_at date, category string, price double"))
    want = [("p", day("2025-01-01"), day("2025-01-09"), "c", 40.0, False), ("p", day("2025-01-09"), None, "c", 45.0, True)]
    same(got, want, "product_id string, effective_from date, effective_to date, category string, price double, is_current boolean")
    updates = [(1, "w", 9.0, "2025-01-01 10:00", 1), (1, "w", 9.0, "2025-01-01 10:00", 1), (1, "v", 8.0, "2025-01-01 10:00", 2)]
    current = serving.current_catalog(spark.createDataFrame(updates, "product_id int, product_name string, price double, updated_at string, source_seq int"))
    same(current, [(1, "v", 8.0, "2025-01-01 10:00", 3)], "product_id int, product_name string, price double, updated_at string, n_versions bigint")


# ---------------------------------------------------------------- reports


def test_dense_store_report(spark):
    sales = spark.createDataFrame(
        [(1, 5, ts("2025-03-02 03:00:00"), 10.0), (2, 5, ts("2025-03-01 03:00:00"), 99.0), (3, 6, ts("2025-03-02 00:00:00"), 1.5), (4, 6, ts("2025-03-02 23:59:59"), 2.0)],
        "txn_id int, store_id int, ts_utc timestamp_ntz, amount double",
    )
    stores = spark.createDataFrame([(5, "America/Denver"), (6, "UTC"), (7, "Asia/Tokyo")], "store_id int, tz string")
    got = serving.dense_store_report(sales, stores, date(2025, 3, 1), date(2025, 3, 2))
    want = [
        (5, day("2025-03-01"), 10.0, 1),
        (5, day("2025-03-02"), 0.0, 0),
        (6, day("2025-03-01"), 0.0, 0),
        (6, day("2025-03-02"), 3.5, 2),
        (7, day("2025-03-01"), 0.0, 0),
        (7, day("2025-03-02"), 0.0, 0),
    ]
    same(got, want, "store_id int, d date, revenue double, n_txn bigint")


def test_store_trend(spark):
    daily = spark.createDataFrame(
        [("a", day("2025-01-01"), -10.0), ("a", day("2025-01-02"), 5.0), ("a", day("2025-01-03"), 0.0), ("a", day("2025-01-04"), 7.0)],
        "store_id string, sale_date date, revenue double",
    )
    want = [
        ("a", day("2025-01-01"), -10.0, -1.43, 0.0, None),
        ("a", day("2025-01-02"), 5.0, -0.71, -10.0, -150.0),
        ("a", day("2025-01-03"), 0.0, -0.71, 5.0, -100.0),
        ("a", day("2025-01-04"), 7.0, 0.29, 0.0, None),
    ]
    same(serving.store_trend(daily), want, "store_id string, sale_date date, revenue double, ma7 double, prev_day_revenue double, dod_growth_pct double")


def test_outreach(spark):
    customers = spark.createDataFrame([(i, "X") for i in range(1, 5)], "cust_id int, country string")
    orders = spark.createDataFrame([(1, 1), (2, 1), (3, 2), (4, 3)], "order_id int, cust_id int")
    complaints = spark.createDataFrame([(1, 2), (2, None)], "complaint_id int, cust_id int")
    same(serving.outreach_list(customers, orders, complaints), [(1, "X"), (3, "X")], "cust_id int, country string")


def test_outreach_list_takes_every_order(spark, tmp_path):
    """Any order makes a buyer, whatever its status, priority or number; a complaint of nobody excludes nobody."""
    spark.createDataFrame([(i, i) for i in range(1, 6)], "c_custkey bigint, c_nationkey int").write.parquet(f"{tmp_path}/customer.parquet")
    orders = [(1, 1, "F", "5-LOW"), (2, 2, "O", "2-HIGH"), (7, 3, "P", "1-URGENT"), (8, 4, "P", "5-LOW"), (9, None, "P", "1-URGENT")]
    spark.createDataFrame(orders, "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    events = [(1, 2, "error"), (2, 1, "view"), (3, 4, "error"), (4, None, "error")]
    spark.createDataFrame(events, "event_id bigint, user_id bigint, event_type string").write.parquet(f"{tmp_path}/events.parquet")
    same(QUERIES["outreach_list"](spark, str(tmp_path)), [(1, "N1"), (3, "N3"), (4, "N4")], "cust_id bigint, country string")


def test_best_offers(spark):
    catalog = spark.createDataFrame([("a", None, "base"), ("a", "red", "red"), ("b", None, "poa"), ("c", "x", "none")], "sku string, variant string, product_name string")
    offers = spark.createDataFrame(
        [("a", None, "zed", 5.0), ("a", None, "amy", 5.0), ("a", None, "poa", None), ("a", "red", "bob", 1.0), ("b", None, "cat", None), ("q", None, "x", 1.0)],
        "sku string, variant string, seller string, price double",
    )
    want = [("a", "BASE", "base", 3, "amy", 5.0), ("a", "red", "red", 1, "bob", 1.0), ("b", "BASE", "poa", 1, "NONE", None), ("c", "x", "none", 0, "NONE", None)]
    same(reports.best_offers(catalog, offers), want, "sku string, variant_label string, product_name string, n_offers bigint, best_seller string, best_price double")


def test_ingestion_report(spark):
    raw = [
        ("1", "web", "$1,000.50", "5"),
        ("2", "web", "-$0.50", "12.0"),
        ("3", "web", "n/a", "x"),
        ("4", "pos", None, "0"),
        ("5", "pos", "NaN", "2.5"),
        ("6", "app", "10", None),
    ]
    df = spark.createDataFrame(raw, "record_id string, source string, amount_raw string, units_raw string")
    want = [("web", 3, 1, 1000.0, 17, 58.82), ("pos", 2, 2, None, 0, None), ("app", 1, 0, 10.0, 0, None)]
    ddl = "source string, n_records bigint, n_bad_amount bigint, net_amount double, total_units bigint, avg_unit_price double"
    for route in ("regex", "mask"):
        same(reports.ingestion_report(df, route), want, ddl)


def test_activity_and_revenue(spark):
    raw = [("u1", "2025-01-02", "purchase", -3.0), ("u1", "2025/01/02", "view", 2.25), ("u2", "2025-01-02", "purchase", None), (None, "2025-01-02", "purchase", 9.0), ("u1", "2025/01/01", "view", 1.0)]
    got = reports.daily_activity(spark.createDataFrame(raw, "user_id string, event_time string, event_type string, price double"))
    want = [(day("2025-01-01"), 1, 0, 1.0), (day("2025-01-02"), 2, 2, 2.25)]
    assert [tuple(r) for r in got.collect()] == want
    sales = spark.createDataFrame([(1, 1, 10), (2, 9, 5), (3, 1, 1)], "txn_id int, store_id int, amount int")
    stores = spark.createDataFrame([(1, "W"), (2, "N")], "store_id int, region string")
    same(reports.region_revenue(sales, stores), [("UNKNOWN", 5), ("W", 11)], "region string, revenue bigint")


def test_journey_and_signals(spark):
    clicks = [("e1", "u", ts("2025-01-01 10:00:00"), "p"), ("e1", "u", ts("2025-01-01 10:00:05"), "p"), ("e2", "u", ts("2025-01-03 10:00:05"), "p")]
    df = spark.createDataFrame(clicks, "event_id string, user_id string, click_time timestamp_ntz, page_id string")
    want = [("e1", "u", ts("2025-01-01 10:00:05"), 0), ("e2", "u", ts("2025-01-03 10:00:05"), 172800)]
    same(reports.user_journey(df, timedelta(hours=1)), want, "event_id string, user_id string, click_time timestamp_ntz, time_diff_sec bigint")
    events = spark.createDataFrame([("1", "d", 1.005), ("2", "d", 2.0), ("2", "x", 2.0)], "event_id string, device_id string, signal_strength double")
    devices = spark.createDataFrame([("d", "M")], "device_id string, device_model string")
    got = reports.device_signals(events, devices)
    same(got, [("M", 1.5, 2)], "device_model string, avg_signal double, total_events bigint")
