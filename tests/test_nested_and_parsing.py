"""Nested reports, payloads and dirty text."""

import pytest
from helpers import rows, same
from pyspark.sql import functions as F

from millrace.functions import parsing, payload, timing, values
from millrace.operators import nested, rowwise


@pytest.mark.parametrize("route", ["explode", "flatten"])
def test_array_summary(spark, route):
    data = [(1, "ann", ["fig", "fig", "kiwi"]), (2, "ann", ["date"]), (2000, "ann", ["kiwi"]), (3, "bo", []), (4, "cy", None), (5, "cy", ["fig"])]
    df = spark.createDataFrame(data, "id bigint, c string, items array<string>")
    got = nested.array_summary(df, ["c"], "items", route=route, row_id="id")
    assert {r["c"]: (r["distinct_items"], r["total_items"]) for r in got.collect()} == {
        "ann": (["date", "fig", "kiwi"], 5),
        "bo": ([], 0),
        "cy": (["fig"], 1),
    }


def test_map_report_counts_the_property_not_the_value(spark):
    data = [
        (1, 7, {"device": "mobile", "os": "x"}),
        (2, 7, {"channel": "mobile"}),
        (3, 7, None),
        (4, 8, {}),
        (5, 9, None),
        (6, 9, {"device": "tv"}),
    ]
    df = spark.createDataFrame(data, "id int, u int, props map<string,string>")
    got = nested.map_report(df, ["u"], "props", "device", "mobile")
    same(
        got,
        [(7, 3, 1, 3), (8, 1, 0, 0), (9, 2, 0, 1)],
        "u int, total_events bigint, mobile_events bigint, distinct_keys bigint",
    )
    flat = nested.map_rows(df, ["id"], "props")
    assert flat.count() == 7 and rows(flat.filter("id = 4")) == [(4, None, None)]


def test_struct_profile(spark):
    data = [
        (1, "e", ("iOS", "1")),
        (1, "e", ("iOS", "2")),
        (1, "e", ("Web", None)),
        (2, "e", ("b", None)),
        (2, "e", ("a", None)),
        (3, "e", (None, "9")),
        (4, "e", None),
    ]
    df = spark.createDataFrame(data, "u int, t string, device struct<os:string,version:string>")
    got = nested.struct_profile(df, ["u"], "device.os", ["iOS", "Android"])
    want = [(1, 3, 2, 2, "iOS"), (2, 2, 0, 2, "a"), (3, 1, 0, 0, "UNKNOWN"), (4, 1, 0, 0, "UNKNOWN")]
    same(got, want, "u int, total_events bigint, mobile_events bigint, distinct_os bigint, primary_os string")


ITEM = "array<struct<sku:string,qty:int,unit_price:double,status:string,in_stock:boolean>>"


def test_line_summary_routes(spark):
    def line(qty, price, status="ACTIVE", stock=True):
        return ("s", qty, price, status, stock)

    data = [
        ("mixed", [line(10, 1.1), line(99, 5.0, "CANCELLED", False), line(1, 0.3)]),
        ("out", [line(9, 2.0, stock=False), line(1, 1.0)]),
        ("gone", [line(50, 1.0, "CANCELLED")]),
        ("empty", []),
        ("null", None),
    ]
    df = spark.createDataFrame(data, f"order_id string, items {ITEM}")
    want = [
        ("mixed", 2, 11.3, True, True),
        ("out", 2, 19.0, False, False),
        ("gone", 0, 0.0, False, False),
        ("empty", 0, 0.0, False, False),
        ("null", 0, 0.0, False, False),
    ]
    ddl = "order_id string, n_active int, active_total double, has_bulk boolean, all_in_stock boolean"
    same(nested.line_summary(df, ["order_id"], "items"), want, ddl)
    same(nested.line_summary_exploded(df, ["order_id"], "items"), want, ddl)
    guarded = df.select("order_id", nested.guarded_forall("items", lambda x: x["in_stock"]).alias("ok"))
    assert {r["order_id"]: r["ok"] for r in guarded.collect()}["empty"] is False


def test_flatten_items(spark):
    data = [
        ("a", ("fr", "tv"), [("i1", 2), ("i2", -9), ("i3", None)]),
        ("b", ("de", None), []),
        ("c", None, [("i4", 0)]),
    ]
    df = spark.createDataFrame(
        data, "id string, meta struct<country:string,device:string>, items array<struct<item_id:string,quantity:int>>"
    )
    got = nested.flatten_items(df, ["id"], "meta", ["country", "device"], "items", "quantity")
    want = [("a", "fr", "tv", "i1", 2), ("a", "fr", "tv", "i3", None), ("b", "de", None, None, None), ("c", None, None, "i4", 0)]
    same(got, want, "id string, country string, device string, item_id string, quantity int")


def test_payload_native_equals_udf(spark):
    texts = ["tier=gold&region=us", "region=eu", "", None, "tier=&x=1", "tier", "a=1&tier=Silver&b=2", "tier=a&tier=b=c"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, p string")
    native = df.select("id", payload.n_params("p").alias("n"), payload.param("p", "tier").alias("tier"))
    assert {r["id"]: (r["n"], r["tier"]) for r in native.collect()} == {
        0: (2, "GOLD"),
        1: (1, "UNKNOWN"),
        2: (0, "UNKNOWN"),
        3: (0, "UNKNOWN"),
        4: (2, ""),
        5: (1, "UNKNOWN"),
        7: (2, "B=C"),
        6: (3, "SILVER"),
    }
    count, tier, both = payload.payload_udfs()
    udf = df.select("id", count("p").alias("n"), tier("p").alias("tier"))
    packed = df.withColumn("b", both("p")).select("id", "b.n_params", "b.user_tier")
    assert rows(udf) == rows(native) == rows(packed)
    payload.register_payload_udfs(spark)
    named = spark.sql("SELECT id, payload_count(p) AS n, payload_tier(p) AS tier FROM {d}", d=df)
    assert rows(named) == rows(udf)


MONEY = {
    "$1,250.75": (1250.75, 1250.75, 1250.75),
    " -$80.00 ": (-80.0, -80.0, -80.0),
    "$4321.09": (4321.09, 4321.09, 4321.09),
    "7": (7.0, 7.0, 7.0),
    "5000000000.50": (5000000000.5, 5000000000.5, 5000000000.5),
    "2e3": (2000.0, None, None),
    "twelve": (None, None, None),
    "": (None, None, None),
    "  ": (None, None, None),
    "$": (None, None, None),
    "1.2.3": (None, None, None),
}


def test_parse_money_routes(spark):
    df = spark.createDataFrame([(k,) for k in MONEY] + [(None,)], "t string")
    got = df.select("t", *[parsing.parse_money("t", r).alias(r) for r in ("cast", "regex", "mask")])
    assert {r["t"]: (r["cast"], r["regex"], r["mask"]) for r in got.collect()} == {**MONEY, None: (None,) * 3}
    nan = spark.createDataFrame([("NaN",), ("Infinity",)], "t string")
    assert rows(nan.select(parsing.parse_money("t", "regex"), parsing.parse_money("t", "mask"))) == [(None, None)] * 2


def test_parse_count_and_day(spark):
    want = {"5": 5, " 6 ": 6, "12.0": 12, "2.5": None, "3000000000": None, "-4": -4, "x": None, "": None, None: None}
    df = spark.createDataFrame([(k,) for k in want], "t string")
    assert {r[0]: r[1] for r in df.select("t", parsing.parse_count("t")).collect()} == want
    days = spark.createDataFrame([("2025-07-04",), ("2025/07/04",), ("2025/07/04 10:00:00",), ("2025-07-04 23:59:59",), ("04.07.2025",)], "t string")
    assert [str(r[0]) for r in days.select(parsing.parse_day("t")).collect()] == ["2025-07-04"] * 4 + ["None"]


def test_clean_events(spark):
    data = [("u", "2025-01-02", -5.0), ("u", "2025/01/03", None), (None, "2025-01-02", 1.0)]
    df = spark.createDataFrame(data, "user string, at string, price double")
    got = rowwise.clean_events(df, "user", "at", "price").select(F.col("event_date").cast("string"), "price")
    assert rows(got) == rows(spark.createDataFrame([("2025-01-02", 0.0), ("2025-01-03", None)], "d string, p double"))


def test_route_takes_the_first_rule(spark):
    df = spark.createDataFrame([(1, 5), (2, -5), (3, None)], "id int, n int")
    rules = [("MISSING", F.col("n").isNull()), ("NEGATIVE", F.col("n") < 0), ("ODD", F.col("id") % 2 == 0)]
    got = rowwise.route(df, rules, {"value": F.col("n") * 2}).select("id", "value", "load_status", "reject_reason")
    want = [(1, 10, "ACCEPTED", None), (2, None, "QUARANTINED", "NEGATIVE"), (3, None, "QUARANTINED", "MISSING")]
    same(got, want, "id int, value int, load_status string, reject_reason string")
    assert rows(rowwise.route(df, [], {}).select("load_status").distinct()) == [("ACCEPTED",)]


def test_small_values(spark):
    df = spark.createDataFrame([(1000, 33, 10.0, 0.0), (999, 10, -5.0, -10.0), (-150, 50, 1.0, None)], "a int, p int, c double, b double")
    got = df.select(
        values.net_of_pct(F.col("a"), F.col("p")).alias("net"),
        values.pct_change(F.col("c"), F.col("b")).alias("g"),
        values.bucketize("a", [0, 999], ["low", "mid", "high"]).alias("k"),
        values.any_of("p", [10, 50]).alias("in"),
    )
    assert [tuple(r) for r in got.collect()] == [(670, None, "high", False), (900, -50.0, "high", True), (-75, None, "low", True)]
    filled = rowwise.zero_fill(df, {"b": 0})
    assert dict(filled.dtypes)["b"] == "double" and filled.filter("b IS NULL").count() == 0
    shaped = rowwise.project(df, {"x": "p", "y": F.col("a") + 1})
    assert shaped.columns == ["x", "y"]
    keys = spark.createDataFrame([(" ab ",), (None,)], "k string")
    assert rows(rowwise.normalise_keys(keys, ["k"])) == [("AB",), (None,)]


def test_time_values(spark):
    df = spark.sql(
        "SELECT TIMESTAMP_NTZ '1969-12-31 23:59:59.5' AS a, '2025-03-30 01:30:00' AS b, DATE '2025-03-30' AS d"
    )
    got = df.select(
        timing.epoch_s("a"),
        timing.hour_text("b"),
        timing.stamp_text(timing.local_time("b", F.lit("Europe/Berlin"))),
        timing.stamp_text(timing.utc_of_local_midnight("d", F.lit("Europe/Berlin"))),
        timing.stamp_text(timing.utc_of_local_midnight("d", F.lit("Europe/Berlin"), 1)),
    ).first()
    # The Berlin day of the clock change has 23 hours.
    assert tuple(got) == (-1, "2025-03-30 01:00:00", "2025-03-30 03:30:00", "2025-03-29 23:00:00", "2025-03-30 22:00:00")


def test_interval_predicate(spark):
    df = spark.createDataFrame([(5, 5, 9), (9, 5, 9), (9, 5, None), (4, 5, None)], "t int, lo int, hi int")
    got = df.select(values.in_interval(F.col("t"), F.col("lo"), F.col("hi")).alias("x"))
    assert [r["x"] for r in got.collect()] == [True, False, True, False]
