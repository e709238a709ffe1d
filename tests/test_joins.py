"""Joins, interval joins and salting."""

import random
from datetime import datetime, timedelta

import pytest
from helpers import rows, same, ts
from pyspark.sql import functions as F

from millrace.operators import dyadic, intervals, joins, skew, states


def test_enrich_keeps_orphans_and_drops_unused_members(spark):
    fact = spark.createDataFrame([(1, 10, 5), (2, 11, 6), (3, None, 7)], "id int, s int, amount int")
    dim = spark.createDataFrame([(10, "WEST"), (12, "EAST"), (11, None)], "s int, region string")
    got = joins.enrich(fact, dim, "s", {"region": "UNKNOWN"}).select("id", "region")
    same(got, [(1, "WEST"), (2, "UNKNOWN"), (3, "UNKNOWN")], "id int, region string")


def test_semi_and_anti(spark):
    left = spark.createDataFrame([(1,), (2,), (3,), (None,)], "k int")
    right = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    assert rows(joins.keep_if_exists(left, right, "k")) == [(1,)]
    assert sorted(rows(joins.drop_if_exists(left, right, "k")), key=str) == [(2,), (3,), (None,)]


@pytest.mark.parametrize("listed", [[1], [1, None], [], [None]])
def test_not_in_has_three_values(spark, listed):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    right = spark.createDataFrame([(x,) for x in listed], "v int")
    assert rows(joins.not_in(left, right, "k", "v")) == rows(joins.not_in_by_counts(left, right, "k", "v"))


def test_null_is_a_key_value(spark):
    left = spark.createDataFrame([("a", None, 1), ("a", "x", 2), ("b", None, 3)], "s string, v string, id int")
    right = spark.createDataFrame([("a", None, 7), ("a", "x", 8)], "s string, v string, n int")
    want = [("a", None, 1, 7), ("a", "x", 2, 8), ("b", None, 3, None)]
    got = joins.null_safe_join(left, right, ["s", "v"], ["v"]).select("s", "v", "id", "n")
    same(got, want, "s string, v string, id int, n int")
    filled = joins.sentinel_join(left, right, ["s", "v"], "v", "\u0000").select("s", "v", "id", "n")
    assert rows(filled) == rows(got)
    assert "_filled" not in filled.columns


def test_chain_status_needs_the_last_hop(spark):
    fact = spark.createDataFrame([(1, "d1"), (2, "d2"), (3, "d3"), (4, "d4")], "id int, d string")
    mid = spark.createDataFrame([("d1", "f1"), ("d2", "f9"), ("d3", None)], "d string, f string")
    last = spark.createDataFrame([("f1", 20)], "f string, pct int")
    got = joins.lookup_chain(fact, [(mid, "d", ["f"]), (last, "f", ["pct"])]).select("id", "pct")
    same(got, [(1, 20), (2, None), (3, None), (4, None)], "id int, pct int")


def test_rollup_before_join_does_not_fan_out(spark):
    fact = spark.createDataFrame([(1, 100), (2, 50)], "o int, gross int")
    refunds = spark.createDataFrame([(1, 10), (1, 5)], "o int, r int")
    got = joins.rollup_then_join(fact, refunds, "o", {"r": F.sum("r")})
    same(got, [(1, 100, 15), (2, 50, None)], "o int, gross int, r bigint")
    assert rows(joins.duplicate_keys(refunds, ["o"])) == [(1, 2)]


def test_merge_states_and_complement(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, None), (3, "c")], "k int, v string")
    got = joins.merge_states(old, new, ["k"], ["v"])
    same(got, [(1, "a", "old"), (2, None, "both"), (3, "c", "new")], "k int, v string, origin string")
    split = joins.split_complement(old, old.filter("k = 2"), "k", "st")
    same(split, [(1, "a", "PENDING"), (2, "b", "PUBLISHED")], "k int, v string, st string")


def test_broadcast_only_within_the_bound(spark):
    small = spark.range(10).withColumnRenamed("id", "k")
    plan = spark.range(100).withColumnRenamed("id", "k")

    def hinted(df):
        return "hint" in df._jdf.queryExecution().logical().toString().lower()

    assert hinted(plan.join(joins.broadcast_within(small, 10), "k"))
    assert not hinted(plan.join(joins.broadcast_within(small, 9), "k"))


def brute_region(fact_at, spans, resolve):
    """spans: (lo, hi, name)"""
    spans = sorted(spans, key=lambda s: (s[0], s[2]))
    if resolve == "repair":
        ends = [s[0] for s in spans[1:]] + [None]
        spans = [(lo, min([x for x in (hi, e) if x], default=None), n) for (lo, hi, n), e in zip(spans, ends)]
    hits = [(lo, n) for lo, hi, n in spans if lo <= fact_at and (hi is None or fact_at < hi)]
    return max(hits)[1] if hits else "UNKNOWN"


@pytest.mark.parametrize("resolve", ["repair", "rank"])
@pytest.mark.parametrize("direct,max_rows", [(True, None), (False, None), (False, 1000), (False, 10)])
@pytest.mark.parametrize("seed", [1, 2])
def test_interval_join(spark, resolve, direct, seed, max_rows):
    r = random.Random(seed)
    base = datetime(2025, 1, 1)
    dim, used = [], set()
    for i in range(40):
        k, lo = r.choice([1, 1, 1, 2, 3]), base + timedelta(hours=r.randrange(400))
        if (k, lo) in used:
            continue
        used.add((k, lo))
        dim.append((k, lo, r.choice([None, lo + timedelta(hours=r.randrange(0, 90))]), f"n{i:02d}"))
    facts = [(i, r.choice([1, 1, 2, 3, 4]), base + timedelta(hours=r.randrange(-5, 450))) for i in range(120)]
    f = spark.createDataFrame(facts, "id int, k int, at timestamp_ntz")
    d = spark.createDataFrame(dim, "k int, lo timestamp_ntz, hi timestamp_ntz, name string")
    got = intervals.interval_join(
        f, d, ["k"], "at", "lo", "hi", {"name": "UNKNOWN"}, resolve, ["id"], ["name"], timedelta(hours=30), direct, max_rows
    )
    want = {
        i: brute_region(at, [(lo, hi, n) for dk, lo, hi, n in dim if dk == k], resolve) for i, k, at in facts
    }
    assert {x["id"]: x["name"] for x in got.collect()} == want


@pytest.mark.parametrize("resolve", ["repair", "rank"])
def test_interval_forms_agree_on_nulls_mixed_types_ties_and_far_ends(spark, resolve):
    dim = [
        ("a", "2025-01-01 00:00:00", None, "z"),
        ("a", "2025-01-01 00:00:00", None, "b"),  # equal starts and ends: the smaller name
        ("b", "2025-01-01 00:00:00", "9999-12-31 00:00:00", "far"),
        ("b", "2025-02-01 00:00:00", "2025-02-10 00:00:00", "short"),
        ("b", "2025-03-01 00:00:00", None, "open"),
        ("b", "2025-03-01 00:00:00", "2025-03-05 00:00:00", "closed"),  # equal starts: the end that comes first
        (None, "2025-01-01 00:00:00", None, "nobody"),
    ]
    facts = [(1, "a", "2025-01-01"), (2, None, "2025-01-05"), (3, "b", "2025-02-05"), (4, "b", "2025-02-20")]
    facts += [(5, "b", "2025-03-02"), (6, "c", "2025-01-02"), (7, "a", None), (8, "a", "2024-12-31")]
    f = spark.createDataFrame(facts, "id int, k string, at string")
    d = spark.createDataFrame(dim, "k string, lo string, hi string, name string")
    want = {1: "b", 2: "UNKNOWN", 3: "short", 4: "far" if resolve == "rank" else "UNKNOWN", 5: "closed", 6: "UNKNOWN", 7: "UNKNOWN", 8: "UNKNOWN"}
    days = f.withColumn("at", F.col("at").cast("date"))
    for fact in (f, days):
        for dims in (d, d.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("lo", "hi")})):
            for form in ({"direct": True}, {}, {"max_rows": 1}):
                got = intervals.interval_join(fact, dims, ["k"], "at", "lo", "hi", {"name": "UNKNOWN"}, resolve, ["id"], **form)
                assert {x["id"]: x["name"] for x in got.collect()} == want


def test_close_intervals_routes_agree(spark):
    data = [("s", "2025-01-01", None, 1), ("s", "2025-02-01", "2025-06-01", 2), ("s", "2025-02-01", None, 3), ("t", "2025-01-01", "2025-01-05", 4)]
    dim = spark.createDataFrame(data, "s string, lo string, hi string, id int")
    want = [("s", "2025-01-01", "2025-02-01", 1), ("s", "2025-02-01", "2025-02-01", 2), ("s", "2025-02-01", None, 3), ("t", "2025-01-01", "2025-01-05", 4)]
    for width in (None, timedelta(days=10)):
        same(intervals.close_intervals(dim, ["s"], "lo", "hi", ["id"], width), want, "s string, lo string, hi string, id int")


def test_exclusion_is_half_open_and_never_fans_out(spark):
    at = ["08:59:59", "09:00:00", "09:29:59", "09:30:00", "23:00:00"]
    facts = [(i, "d", ts(f"2025-04-01 {a}")) for i, a in enumerate(at)] + [(9, "other", ts("2025-04-01 09:10:00"))]
    windows = [
        ("d", ts("2025-04-01 09:00:00"), ts("2025-04-01 09:30:00")),
        ("d", ts("2025-03-01 00:00:00"), ts("2025-04-01 09:10:00")),
        ("d", ts("2025-04-01 22:00:00"), None),
        ("d", ts("2025-04-01 08:00:00"), ts("2025-04-01 08:00:00")),
    ]
    f = spark.createDataFrame(facts, "id int, d string, at timestamp_ntz")
    w = spark.createDataFrame(windows, "d string, lo timestamp_ntz, hi timestamp_ntz")
    got = intervals.exclude_intervals(f, w, ["d"], "at", "lo", "hi", timedelta(hours=1))
    assert rows(got.select("id")) == [(3,), (9,)]
    closed_only = intervals.exclude_intervals(f, w.filter("hi IS NOT NULL"), ["d"], "at", "lo", "hi")
    assert rows(closed_only.select("id")) == [(3,), (4,), (9,)]
    far = spark.createDataFrame([("d", ts("2025-04-01 09:15:00"), ts("9999-12-31 00:00:00")), (None, ts("2020-01-01 00:00:00"), None)], w.schema)
    more = f.unionByName(spark.createDataFrame([(20, None, ts("2025-04-01 09:10:00")), (21, "d", None)], f.schema))
    for form in ({}, {"max_rows": 1}):
        got = intervals.exclude_intervals(more, far, ["d"], "at", "lo", "hi", timedelta(hours=1), **form)
        assert rows(got.select("id")) == [(0,), (1,), (9,), (20,), (21,)]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_spread_join_changes_nothing(spark, how):
    left = spark.createDataFrame([(k, i) for k in (1, 1, 1, 2, 3, None, None) for i in range(5)], "k int, id int")
    right = spark.createDataFrame([(1, "a"), (3, "b"), (4, "c"), (None, "d")], "k int, v string")
    want = rows(left.join(right, ["k"], how))
    for max_rows in (4, 9, 100):
        assert rows(joins.join_spread(left, right, ["k"], how, max_rows, n=4)) == want
    with pytest.raises(ValueError):
        joins.join_spread(left, right, ["k"], "full_outer")


def test_rollup_of_hot_facts(spark):
    fact = spark.createDataFrame([(1, i) for i in range(20)] + [(2, 99)], "o int, i int")
    many = spark.createDataFrame([(1, 5), (1, 6)], "o int, r int")
    got = joins.rollup_then_join(fact, many, "o", {"r": F.sum("r")}, max_rows=10)
    assert rows(got) == rows(joins.rollup_then_join(fact, many, "o", {"r": F.sum("r")}))


def hot_orders(spark):
    data = [(i, "hot", f"p{i % 4}", 1.25) for i in range(12)] + [(100, "cold", "p0", 2.5), (101, "lost", "p1", 9.0)]
    return spark.createDataFrame(data, "order_id int, customer_id string, product string, amount double")


@pytest.mark.parametrize("hot", [False, True])
@pytest.mark.parametrize("route", ["key", "set"])
def test_salting_changes_nothing(spark, hot, route):
    from millrace.plans.reports import salted_customer_summary

    orders = hot_orders(spark)
    dim = spark.createDataFrame([("hot", "ENT"), ("cold", "SMB"), ("idle", "SMB")], "customer_id string, segment string")
    keys = skew.hot_keys(orders, "customer_id", 0.5) if hot else None
    got = salted_customer_summary(orders, dim, n=3, hot=keys, route=route)
    want = [("hot", "ENT", 15.0, 4), ("cold", "SMB", 2.5, 1)]
    same(got, want, "customer_id string, segment string, total_amount double, n_products bigint")
    left = skew.salted_join(orders, dim, "customer_id", "order_id", 3, hot=keys, how="left")
    assert left.count() == orders.count() and "_salt" not in left.columns
    assert skew.salted_join(orders, dim, "customer_id", None, 3).count() == 13


def test_hot_keys_are_few(spark):
    assert rows(skew.hot_keys(hot_orders(spark), "customer_id", 0.5)) == [("hot",)]


@pytest.mark.parametrize("verify", [False, True])
def test_hot_keys_among_far_more_keys_than_counters(spark, verify):
    """A key of the share is always found, one below half of it never, and only the column is read, once."""
    n, share = 60_000, 0.02
    id = F.col("id")
    key = F.when(id % 3 == 0, "third").when(id % 50 == 1, "edge").when(id % 125 == 2, "below").when(id % 17 == 4, None)
    df = spark.range(n).select(key.otherwise(id.cast("string")).alias("k"), F.lit(1).alias("other"))
    exact = {r["k"]: r["count"] for r in df.groupBy("k").count().collect() if r["k"] is not None}
    got = {r["k"] for r in skew.hot_keys(df, "k", share, verify).collect()}
    due = {k for k, c in exact.items() if c >= share * n}
    assert due <= got and all(exact[k] >= share * n / 2 for k in got) and len(got) <= 2 / share
    if verify:
        assert got == due
    assert skew.hot_keys(df.limit(0), "k", share, verify).count() == 0
    with pytest.raises(ValueError):
        skew.hot_keys(df, "k", 1e-6)


def test_set_route_counts_in_bitmaps(spark):
    data = [(i, "hot" if i % 3 else "cold", None if i % 11 == 0 else f"p{i % 700}", 1.0) for i in range(3000)]
    orders = spark.createDataFrame(data, "order_id int, customer_id string, product string, amount double").withColumn("salt", F.col("order_id") % 4)
    args = (["customer_id"], "salt", {"total": "amount"}, {"n": "product"})
    want = rows(orders.groupBy("customer_id").agg(F.sum("amount").alias("total"), F.count_distinct("product").alias("n")))
    by_set = skew.salted_agg(orders, *args, route="set")
    assert rows(by_set) == want == rows(skew.salted_agg(orders, *args, route="key"))
    plan = by_set._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_set" not in plan and "bitmap_construct_agg" in plan
    # Too many values for one bitmap: the other route, the same rows.
    assert states.vocabulary(orders, "product", most=50) is None and states.vocabulary(orders, "product").count() == 700
    with pytest.raises(ValueError):
        skew.salted_agg(orders, *args, route="bag")


def test_states_merge_in_any_order(spark):
    data = [(f"k{i % 3}", None if i % 4 == 0 else (i * 7919) % 100_000 - 50_000) for i in range(4000)] + [("none", None)]
    df = spark.createDataFrame(data, "k string, v bigint")
    want = rows(df.groupBy("k").agg(F.count_distinct("v").alias("n")))
    halves = [states.bitmap_states(df.filter(F.xxhash64("v") % 2 == s), ["k"], "v") for s in (0, 1, -1)]
    merged = states.bitmap_union(halves[2].unionByName(halves[0]), ["k"]).unionByName(halves[1]).unionByName(halves[0])
    assert rows(states.bitmap_counts(merged, ["k"], "n")) == want
    whole = states.bitmap_states(df, ["k"], "v")
    assert whole.agg(F.max(F.length("bits"))).first()[0] == states.BITS // 8
    sketches = [states.sketch_states(df.filter(F.xxhash64("v") % 2 == s), ["k"], "v") for s in (0, 1, -1)]
    both = sketches[0].unionByName(sketches[1]).unionByName(sketches[2]).unionByName(sketches[0])
    for (k, n), (_, likely) in zip(want[:3], rows(states.sketch_counts(both, ["k"], "n"))):
        assert abs(n - likely) <= max(1, 3 * 1.04 / 64 * n), k


def test_windows_of_states_repeat_states_only(spark):
    base = datetime(2024, 2, 27)
    df = spark.createDataFrame([("a", base + timedelta(hours=5 * i), i % 9) for i in range(60)], "k string, at timestamp_ntz, u bigint")
    day = timedelta(days=1)
    slides = df.withColumn("slide", states.slide_of("at", day))
    kept = states.bitmap_states(slides, ["k", "slide"], "u")
    out = states.bitmap_counts(states.windows_of(kept, 3 * day, day), ["k", "window_start", "window_end"], "n")
    want = {}
    for r in df.collect():
        first = datetime(r["at"].year, r["at"].month, r["at"].day)
        for i in range(3):
            want.setdefault(first - i * day, set()).add(r["u"])
    assert {(r["window_start"], r["window_end"], r["n"]) for r in out.collect()} == {(s, s + 3 * day, len(u)) for s, u in want.items()}
    with pytest.raises(ValueError):
        states.windows_of(kept, timedelta(hours=25), day)


def test_cells_make_up_the_interval(spark):
    r = random.Random(5)
    spans = [(a, a + r.randrange(1, 3000)) for a in (r.randrange(-2000, 2000) for _ in range(300))]
    spans += [(0, 1 << 20), (-(1 << 20), 1 << 20), (-1, 1), (-1, 0), (0, 1), (-7, (1 << 50) + 3)]
    df = spark.createDataFrame(spans, "a bigint, b bigint")
    for a, b, cells in df.select("a", "b", dyadic.cells(F.col("a"), F.col("b"), F.lit(58))).collect():
        parts = sorted((c.cell << c.level, (c.cell + 1) << c.level) for c in cells)
        assert parts[0][0] == a and parts[-1][1] == b and all(x[1] == y[0] for x, y in zip(parts, parts[1:]))
        assert len(parts) <= 2 * max(1, (b - a).bit_length())


def test_decades_at_one_day_grain_take_logarithmically_many_rows(spark):
    start = datetime(1971, 3, 2)
    rows = [(k, start + timedelta(days=k), start + timedelta(days=k + 365 * 30), f"n{k}") for k in range(50)]
    dim = spark.createDataFrame(rows, "k int, lo timestamp_ntz, hi timestamp_ntz, name string")
    sized = dyadic.measured(dim, "lo", "hi")
    assert {(r["_unit"] // 86_400_000_000, r["_top"]) for r in sized.collect()} == {(1, 14)}
    assert dyadic.cell_rows(sized, ["k"], ["name"]).count() <= 50 * 2 * 14
    hourly = dim.withColumn("hi", F.col("hi") + F.expr("INTERVAL 1 HOUR"))
    assert {r["_unit"] // 3_600_000_000 for r in dyadic.measured(hourly, "lo", "hi").collect()} == {1}


def test_many_that_overlap_meet_one_row_per_level(spark):
    """A thousand nested intervals of one key: an instant asks its levels, and every answer is the innermost."""
    base = datetime(2025, 1, 1)
    dim = [(1, base + timedelta(minutes=i), base + timedelta(minutes=4000 - i), f"n{i:04d}") for i in range(1000)]
    facts = [(i, 1, base + timedelta(minutes=i, seconds=30)) for i in range(-5, 4010, 37)]
    f = spark.createDataFrame(facts, "id int, k int, at timestamp_ntz")
    d = spark.createDataFrame(dim, "k int, lo timestamp_ntz, hi timestamp_ntz, name string")
    got = intervals.interval_join(f, d, ["k"], "at", "lo", "hi", {"name": None}, "rank")
    want = {i: max([n for _, lo, hi, n in dim if lo <= at < hi], default=None) for i, _, at in facts}
    assert {r["id"]: r["name"] for r in got.collect()} == want
    side = d.withColumn("_hit", F.struct("lo", "name"))
    steps = dyadic.highest_cover(side, ["k"], "lo", "hi", "_hit", "since")
    assert steps.count() == len({x for _, lo, hi, _ in dim for x in (lo, hi)})
    empty = intervals.interval_join(f, d.limit(0), ["k"], "at", "lo", "hi", {"name": "none"}, "rank")
    assert {r["name"] for r in empty.collect()} == {"none"}


def test_bitmaps_are_counted_without_being_sorted(spark):
    """States are dealt as ids and counted as words: no aggregate over whole bitmaps, which shrink on their way, takes part."""
    df = spark.range(5000).select((F.col("id") % 7).alias("k"), (F.col("id") % 500).alias("d"), (F.col("id") * 7919 % 300_000 - 150_000).alias("v"))
    df = df.unionByName(df.limit(40)).unionByName(df.limit(1).select(F.lit(9).cast("bigint").alias("k"), F.lit(0).cast("bigint").alias("d"), F.lit(None).cast("bigint").alias("v")))
    kept = states.bitmap_states(df, ["k", "d"], "v")
    assert kept.count() == kept.select("k", "d", "bucket").distinct().count()
    counted = states.bitmap_counts(kept, ["k"], "n")
    assert rows(counted) == rows(df.groupBy("k").agg(F.count_distinct("v").alias("n")))
    assert "bitmap_or_agg" not in counted._jdf.queryExecution().optimizedPlan().toString()
    # One construction from ids that have already arrived: nothing partial is sent.
    construct = [x for x in kept._jdf.queryExecution().executedPlan().toString().split("\n") if "bitmap_construct_agg" in x or "Exchange" in x]
    assert "Exchange" in construct[2] and all("bitmap_construct_agg" in x for x in construct[:2])
    whole = spark.createDataFrame([(0, i) for i in (-32_768, -1, 0, 63, 64, 32_767, 32_768, 65_536)] + [(1, i) for i in range(64)], "k int, v bigint")
    assert rows(states.bitmap_counts(states.bitmap_states(whole, ["k"], "v"), ["k"], "n")) == [(0, 8), (1, 64)]


def test_highest_cover_numbers_are_not_sorted_as_structures(spark):
    """Equal starts, ends that meet starts, open and empty windows, against brute force; aggregates of numbers only."""
    r = random.Random(11)
    base = datetime(2025, 1, 1)
    at = lambda h: base + timedelta(hours=h)
    dim = [(r.choice(["a", "a", "b", None]), a, r.choice([None, a, a + 1, a + r.randrange(-1, 40)]), f"n{i:03d}") for i, a in enumerate(r.choices(range(25), k=150))]
    d = spark.createDataFrame([(k, at(a), None if z is None else at(z), n) for k, a, z, n in dim], "k string, lo timestamp_ntz, hi timestamp_ntz, name string")
    side = d.withColumn("_hit", F.struct("lo", "name"))
    steps = dyadic.highest_cover(side, ["k"], "lo", "hi", "_hit", "since")
    got = {(x["k"], x["since"]): x["_hit"] and x["_hit"]["name"] for x in steps.collect()}
    assert steps.count() == len(got) and {k for k, _ in got} == {"a", "b"}
    for k in "ab":
        seen = None
        for h in range(-1, 70):
            seen = got.get((k, at(h)), seen)
            assert seen == max([(a, n) for dk, a, z, n in dim if dk == k and a <= h and (z is None or h < z)], default=(0, None))[1], (k, h)
    plan = steps._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan
