"""Shapes of the physical plans: shuffles, broadcasts, pushed filters, rows sent per task."""

import re
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from millrace.operators import grouping, joins, nested, ranking, timeline
from millrace.plans import facts, reports, serving
from millrace.workload import aggregates, incremental, nested as nested_workload
from millrace.workload import timeline as timeline_workload
from millrace.workload.registry import QUERIES, Given

FOLDER = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df) -> int:
    return len(re.findall(r"[^a-zA-Z]Exchange ", plan(df)))


@pytest.fixture
def given(spark, monkeypatch):
    """Jobs with the staging taken out, so the job's own plan shows."""
    for module in (facts, serving):
        monkeypatch.setattr(module, "publish", lambda df, gates, label="": df)
    return Given(spark, FOLDER)


def test_enrichment_is_one_shuffle(given):
    facts_only = given.orders.select(F.col("o_custkey").alias("store_id"), F.col("o_orderkey").alias("amount"))
    dim = given.customer.select(F.col("c_custkey").alias("store_id"), F.col("c_mktsegment").alias("region"))
    df = reports.region_revenue(facts_only, dim)
    assert shuffles(df) == 1 and plan(df).count("BroadcastExchange") == 1


def test_versions_are_one_shuffle_one_sort_two_windows(given):
    df = timeline_workload.scd2_history(given)
    assert shuffles(df) == 1
    assert len(re.findall(r"- Sort |^Sort ", plan(df))) == 1
    assert len(re.findall(r"- Window |^Window ", plan(df))) == 2


def test_sessions_combine_before_the_shuffle(given):
    text = plan(timeline.gap_sessions(given.events, ["user_id"], "ts", timedelta(hours=6)))
    below = text.split("FileScan")[0].rsplit("Exchange", 1)[1]
    assert "partial_count" in below and "Window" not in below


def test_grouping_sets_are_one_scan_one_expand_one_shuffle(given):
    df = aggregates.grouping_sets_report(given)
    assert shuffles(df) == 1 and plan(df).count("Expand") == 1


def test_array_summaries(given):
    assert shuffles(nested_workload.line_summary(given)) == 0
    assert shuffles(nested_workload.line_summary_exploded(given)) == 1


def test_filtered_array_is_evaluated_once(given):
    lines = given.spark.read.schema("id int, items array<struct<qty:int,unit_price:double,status:string,in_stock:boolean>>")
    text = plan(nested.line_summary(lines.parquet(FOLDER + "/orders.parquet"), ["id"], "items"))
    assert text.count("filter(items") == 1


def test_ingestion_report_is_one_shuffle(given):
    for query in (nested_workload.ingestion_report, nested_workload.ingestion_report_mask):
        assert shuffles(query(given)) == 1


def test_upsert_by_rank(given):
    df = incremental.cdc_upsert(given)
    assert shuffles(df) <= 2 and plan(df).count("FileScan") == 3
    assert "WindowGroupLimit" in plan(df)


def test_jobs_with_small_dimensions_do_not_shuffle(given):
    for query in (incremental.staging_routed, incremental.payout_resolution):
        assert shuffles(query(given)) == 0


def test_region_report(given):
    assert shuffles(incremental.effective_region_gmv(given)) <= 6


def test_device_hours(given):
    assert shuffles(incremental.interval_exclusion_hourly(given)) <= 3


def test_campaign_report(given):
    derived = 2  # the flights and placements are distinct over a small table here
    assert shuffles(incremental.local_day_campaign(given)) <= 1 + derived


def test_flight_bounds_reach_the_scan(given):
    text = plan(incremental.local_day_pushdown(given))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(ts,[^\]]*LessThan\(ts,", text)


def test_latest_sends_one_row_per_key_and_task(given):
    text = plan(ranking.keep_latest(given.orders, ["o_custkey"], ["o_orderdate"]))
    assert re.search(r"WindowGroupLimit.*Partial", text)


def test_sentinel_key_reuses_its_partitioning(given, spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = given.part.select(F.col("p_brand").alias("sku"), F.col("p_type").alias("variant"), "p_partkey")
        right = left.groupBy("sku", "variant").agg(F.count(F.lit(1)).alias("n"))
        filled = joins.sentinel_join(left, right, ["sku", "variant"], "variant", "(none)")
        safe = joins.null_safe_join(left, right, ["sku", "variant"], ["variant"])
        assert shuffles(filled) <= shuffles(safe) == 3
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")


@pytest.mark.parametrize("route,want", [("set", 3), ("key", 4)])
def test_salted_summary(given, spark, route, want):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        orders = given.orders.select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderpriority").alias("product"),
            F.col("o_totalprice").alias("amount"),
        )
        dim = given.customer.select(F.col("c_custkey").alias("customer_id"), F.col("c_mktsegment").alias("segment"))
        assert shuffles(reports.salted_customer_summary(orders, dim, route=route)) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")


def test_no_cross_joins(given):
    import __spark_entry__ as entry

    for name in ("dense_local_report", "date_spine", "calendar_report", "cube_report", "not_in_list"):
        df = entry.queries()[name](given.spark, FOLDER)
        assert "CartesianProduct" not in plan(df) and "BroadcastNestedLoopJoin" not in plan(df), name


def test_pivot_reads_two_columns(given):
    df = grouping.pivot_sum(given.orders, ["o_orderstatus"], "o_orderpriority", ["1-URGENT"], F.count(F.lit(1)))
    assert "ReadSchema: struct<o_orderstatus:string,o_orderpriority:string>" in plan(df)


def test_ordered_operators_start_no_job_and_scan_once(spark, given):
    tracker = spark.sparkContext.statusTracker()
    # The feed of user_journey is a table and its resent rows; top_customers reads the nations as well.
    scans = {"rolling_7d": 1, "user_journey": 2, "scd2_history": 1, "top_customers": 2}
    for name, n in scans.items():
        group = f"calling {name}"
        spark.sparkContext.setJobGroup(group, name)
        df = QUERIES[name](spark, given.folder)
        assert not tracker.getJobIdsForGroup(group), name
        assert plan(df).count("FileScan ") == n, name
    spark.sparkContext.setJobGroup("", "")


def test_best_rows_do_not_sort_before_the_shuffle(spark, given):
    for name in ("current_catalog", "argmax_order"):
        assert "SortAggregate" not in plan(QUERIES[name](spark, given.folder)), name


def test_hot_summary_scans_the_facts_twice(given, spark):
    """Once for the heavy keys, the key column only, and once for the summary; no census of all keys."""
    from millrace.operators import skew

    orders = given.orders.select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"), F.col("o_orderpriority").alias("product"), F.col("o_totalprice").alias("amount"))
    dim = given.customer.select(F.col("c_custkey").alias("customer_id"), F.col("c_mktsegment").alias("segment"))
    df = reports.salted_customer_summary(orders, dim, n=8, hot=skew.hot_keys(orders, "customer_id", 0.05))
    text = plan(df)
    assert text.count("orders.parquet") == 1 and "partial_count(1)" not in text
