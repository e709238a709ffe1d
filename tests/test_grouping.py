"""Grains, pivots, unpivots and their routes."""

import random
from collections import Counter
from datetime import date
from decimal import Decimal

import pytest
from helpers import rows, same
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from millrace.functions.values import count_where, exact_avg, exact_sum, exact_total
from millrace.operators import grouping, lattice, reshape

LEVELS = {("r", "c"): "both", ("r",): "r", ("c",): "c", (): "all"}


def sales(spark):
    data = [("N", "food", 10.0), ("N", "toys", 1000.0), ("S", "food", 999.99), (None, "food", 4.0)]
    return spark.createDataFrame(data, "r string, c string, amount double")


def test_cube_keeps_a_real_null_apart_from_all(spark):
    got = grouping.multi_grain(sales(spark), ["r", "c"], {"total": exact_sum("amount")}, levels=LEVELS)
    want = [
        ("N", "food", "both", 10.0),
        ("N", "toys", "both", 1000.0),
        ("S", "food", "both", 999.99),
        (None, "food", "both", 4.0),
        ("N", "ALL", "r", 1010.0),
        ("S", "ALL", "r", 999.99),
        (None, "ALL", "r", 4.0),
        ("ALL", "food", "c", 1013.99),
        ("ALL", "toys", "c", 1000.0),
        ("ALL", "ALL", "all", 2013.99),
    ]
    same(got.select("r", "c", "level", "total"), want, "r string, c string, level string, total double")
    named = grouping.multi_grain(
        sales(spark), ["r", "c"], {"total": exact_sum("amount")}, levels=LEVELS, null_labels={"r": "(none)"}
    )
    assert ("(none)", "ALL", 4.0) in rows(named.select("r", "c", "total"))


def test_grouping_sets_against_other_routes(spark):
    df = sales(spark)
    aggs = {"total": exact_sum("amount"), "big": count_where(F.col("amount") >= 1000)}
    sets = grouping.multi_grain(df, ["r", "c"], aggs, grains=[["r", "c"], ["r"], ["c"]], levels=LEVELS)
    assert rows(sets.filter("level = 'all'")) == []
    assert rows(sets.filter("level = 'c'").select("c", "big")) == [("food", 0), ("toys", 1)]
    cubed = grouping.cube_then_filter(df, ["r", "c"], aggs, drop_ids=[3])
    assert cubed.count() == sets.count()
    one = df.groupBy("r", "c").agg(*[e.alias(n) for n, e in aggs.items()])
    by_r = df.groupBy("r").agg(*[e.alias(n) for n, e in aggs.items()]).withColumn("c", F.lit("ALL"))
    by_c = df.groupBy("c").agg(*[e.alias(n) for n, e in aggs.items()]).withColumn("r", F.lit("ALL"))
    union = one.unionByName(by_r).unionByName(by_c)
    cols = ["r", "c", "total", "big"]
    assert rows(sets.select(cols)) == rows(union.select(cols))


def test_rollup_ids(spark):
    got = grouping.multi_grain(
        sales(spark), ["r", "c"], {"t": exact_sum("amount")}, "rollup", all_labels={"r": "ALL_R", "c": "ALL_C"}
    )
    ids = {(r["r"], r["c"]): r["grain_id"] for r in got.collect()}
    assert ids[("ALL_R", "ALL_C")] == 3 and ids[("N", "ALL_C")] == 1 and ids[("N", "food")] == 0


def visits(spark):
    data = [("x", "mon", 3), ("x", "mon", 4), ("x", "tue", 5), ("y", "wed", 6), ("z", "tue", None)]
    return spark.createDataFrame(data, "s string, d string, n int")


def test_pivot_routes(spark):
    df = visits(spark)
    want = [("x", 7, 5), ("y", 0, 0), ("z", 0, 0)]
    same(
        grouping.pivot_sum(df, ["s"], "d", ["mon", "tue"], F.sum("n"), fill=0),
        want,
        "s string, mon bigint, tue bigint",
    )
    portable = grouping.pivot_by_condition(df, ["s"], "d", ["mon", "tue"], "n")
    assert rows(portable) == [(a, float(b), float(c)) for a, b, c in want]
    assert grouping.pivot_dynamic(df, ["s"], "d", F.sum("n")).columns == ["s", "mon", "tue", "wed"]
    multi = grouping.pivot_multi(df, ["s"], "d", ["mon"], {"sum": F.sum("n"), "n": F.count(F.lit(1))})
    same(multi, [("x", 7, 2), ("y", None, None), ("z", None, None)], "s string, mon_sum bigint, mon_n bigint")


def quarters(spark):
    return spark.createDataFrame([("a", 1, None, 3), ("b", None, None, None)], "s string, q1 int, q2 int, q3 int")


def test_unpivot_null_rules(spark):
    df, cols = quarters(spark), ["q1", "q2", "q3"]
    full = reshape.melt(df, ["s"], cols, "q", "v")
    assert full.count() == 6
    assert rows(full) == rows(reshape.melt(df, ["s"], cols, "q", "v", route="stack"))
    assert rows(full) == rows(reshape.unpivot_sql(df, ["s"], cols, "q", "v", include_nulls=True))
    kept = [("a", "q1", 1), ("a", "q3", 3)]
    same(reshape.melt(df, ["s"], cols, "q", "v", keep_nulls=False), kept, "s string, q string, v int")
    assert rows(reshape.unpivot_sql(df, ["s"], cols, "q", "v")) == kept


def test_unpivot_types(spark):
    mixed = spark.createDataFrame([("a", 1, 2.5, "x")], "s string, i int, d double, t string")
    wide = reshape.melt(mixed, ["s"], ["i", "d"], "c", "v")
    same(wide, [("a", "i", 1.0), ("a", "d", 2.5)], "s string, c string, v double")
    with pytest.raises(AnalysisException, match="UNPIVOT_VALUE_DATA_TYPE_MISMATCH"):
        reshape.melt(mixed, ["s"], ["i", "t"], "c", "v").count()


def test_unpivot_groups_drops_only_all_null(spark):
    df = spark.createDataFrame([("a", 1, 2, None, 5), ("b", None, None, 7, 8)], "s string, r1 int, u1 int, r2 int, u2 int")
    groups = {"one": ["r1", "u1"], "two": ["r2", "u2"]}
    got = reshape.melt_groups(df, ["s"], groups, "q", ["rev", "units"])
    same(
        got,
        [("a", "one", 1, 2), ("a", "two", None, 5), ("b", "two", 7, 8)],
        "s string, q string, rev int, units int",
    )
    assert reshape.melt_groups(df, ["s"], groups, "q", ["rev", "units"], keep_nulls=True).count() == 4


def test_round_trip(spark):
    wide = grouping.pivot_sum(visits(spark), ["s"], "d", ["mon", "tue", "wed"], F.sum("n"))
    back = reshape.melt(wide, ["s"], ["mon", "tue", "wed"], "d", "n", keep_nulls=False)
    direct = visits(spark).groupBy("s", "d").agg(F.sum("n").alias("n")).filter("n IS NOT NULL")
    assert rows(back) == rows(direct)


def test_collect_sorted_and_empty_input(spark):
    df = spark.createDataFrame([("k", "b"), ("k", "a"), ("k", "b"), ("k", None), ("m", None)], "k string, v string")
    got = grouping.collect_sorted(df, ["k"], "v", "vs", "n")
    assert {r["k"]: (r["vs"], r["n"]) for r in got.collect()} == {"k": (["a", "b"], 3), "m": ([], 0)}
    empty = df.filter("false").agg(
        count_where(F.col("v") == "a").alias("n"), F.sum(F.lit(1)).alias("s"), F.bool_and(F.col("v") == "a").alias("b")
    )
    assert rows(empty) == [(0, None, None)]


def test_array_sorts_place_null_differently(spark):
    df = spark.createDataFrame([(["b", None, "a"],)], "v array<string>")
    got = df.select(F.sort_array("v").alias("first"), F.array_sort("v").alias("last")).first()
    assert got["first"] == [None, "a", "b"] and got["last"] == ["a", "b", None]


def test_exact_sum_of_small_and_large(spark):
    df = spark.createDataFrame([(9.0e12,), (0.004,), (0.004,), (-0.000001,), (-7.25,), (None,)], "v double")
    got = df.agg(exact_total("v").alias("t"), exact_sum("v", 2).alias("s"), exact_avg("v").alias("a")).first()
    assert got["t"] == Decimal("8999999999992.757999") and got["s"] == 8999999999992.76
    assert got["a"] == 1799999999998.55
    empty = df.filter("v IS NULL").agg(exact_sum("v").alias("s"), exact_avg("v").alias("a")).first()
    assert tuple(empty) == (None, None)


def test_exact_sum_does_not_drift(spark):
    df = spark.createDataFrame([(0.1,)] * 10, "v double")
    assert df.agg(exact_sum("v").alias("s")).first()["s"] == float(Decimal("1.0"))


def test_lattice_agrees_with_grouping_sets(spark):
    """Any grains, NULLs, a counted column that is a dimension too, and no rows at all."""
    r = random.Random(6)
    rows = [(r.choice(["x", "y", None]), r.choice([1, 2, 3, None]), date(2025, 1, r.randint(1, 3)), r.choice([0.5, 1.25, None, float("nan")] + [2.0] * 30), r.randint(1, 9)) for _ in range(400)]
    df = spark.createDataFrame(rows, "a string, b int, d date, v double, u int")
    plain = {
        "n": F.count(F.lit(1)), "known": F.count("v"), "s": exact_sum("v"), "m": exact_avg("v"), "lo": F.min("u"), "hi": F.max("u"),
        "big": F.count_if(F.col("u") > 5), "us": F.count_distinct("u"), "bs": F.count_distinct("b"),
    }
    ours = {
        "n": lattice.rows(), "known": lattice.known("v"), "s": lattice.exact("v"), "m": lattice.mean("v"), "lo": lattice.low("u"),
        "hi": lattice.high("u"), "big": lattice.rows_where(F.col("u") > 5), "us": lattice.distinct("u"), "bs": lattice.distinct("b"),
    }
    dims = ["a", "b", "d"]
    for grains in ("cube", "rollup", [["a"], ["b", "d"]], [["d"], []]):
        for names in (list(plain), ["n", "us"], ["us"], ["s"]):
            for some in (df, df.limit(0)):
                want = grouping.multi_grain(some, dims, {n: plain[n] for n in names}, grains)
                got = grouping.multi_grain(some, dims, {n: ours[n] for n in names}, grains)
                assert [f.simpleString() for f in got.schema] == [f.simpleString() for f in want.schema]
                assert Counter(map(str, got.collect())) == Counter(map(str, want.collect()))


def test_lattice_sizes_choose_the_parent(spark):
    df = spark.range(60).select((F.col("id") % 30).alias("a"), (F.col("id") % 2).alias("b"), (F.col("id") % 3).alias("c"))
    asked = [["a", "b"], ["b", "c"], ["b"]]
    plain = lattice.rolled_up(df, ["a", "b", "c"], {"n": lattice.rows()}, asked)
    sized = lattice.rolled_up(df, ["a", "b", "c"], {"n": lattice.rows()}, asked, sizes={("a", "b"): 30, ("b", "c"): 6})
    assert rows(plain) == rows(sized)


def test_lattice_expands_nothing_and_reads_rows_once(spark):
    was = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        table = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
        measures = {"n": lattice.rows(), "v": lattice.exact("l_quantity"), "s": lattice.distinct("l_suppkey")}
        df = lattice.rolled_up(table, ["l_returnflag", "l_linestatus", "l_linenumber"], measures)
        text = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", was)
    assert "Expand" not in text and text.count("FileScan") == 1 and "ReusedExchange" in text
