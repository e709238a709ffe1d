"""Timeline operators against brute force in plain Python, over cells shorter than the data."""

import random
from datetime import date, datetime, timedelta

import pytest
from helpers import day, rows, same, ts
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.operators import ranking, timeline

DDL = "k int, at timestamp_ntz, id int, v double"
BASE = datetime(2025, 3, 1)


def make(seed, n=200, null_key=True):
    """One hot key, some rare ones, a NULL key, and repeated instants."""
    r = random.Random(seed)
    keys = [1, 1, 1, 1, 2, 3] + ([None] if null_key else [])
    return [
        (r.choice(keys), BASE + timedelta(minutes=15 * r.randrange(600), microseconds=r.choice([0, 0, 7])), i, r.randrange(1, 9999) / 100)
        for i in range(n)
    ]


def by_key(data):
    out = {}
    for row in sorted(data, key=lambda r: (r[1], r[2])):
        out.setdefault(row[0], []).append(row)
    return out


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("width", [timedelta(hours=3), timedelta(days=30)])
@pytest.mark.parametrize("max_rows", [0, 40, 1000])
def test_neighbours(spark, seed, width, max_rows):
    data = make(seed)
    df = spark.createDataFrame(data, DDL)
    prev = timeline.previous_in_key(df, ["k"], "at", {"id": "p", "v": "pv"}, ["id"], width, max_rows)
    nxt = timeline.next_in_key(df, ["k"], "at", {"id": "n"}, ["id"], width, max_rows)
    want_prev, want_next = {}, {}
    for seq in by_key(data).values():
        for a, b in zip([None, *seq], seq):
            want_prev[b[2]] = (a[2], a[3]) if a else (None, None)
        for a, b in zip(seq, [*seq[1:], None]):
            want_next[a[2]] = b[2] if b else None
    assert {r["id"]: (r["p"], r["pv"]) for r in prev.collect()} == want_prev
    assert {r["id"]: r["n"] for r in nxt.collect()} == want_next


def test_neighbour_carries_null_values(spark):
    data = [(1, ts("2025-01-01 10:00:00"), 1, None), (1, ts("2025-01-05 10:00:00"), 2, 3.0)]
    df = spark.createDataFrame(data, DDL)
    for max_rows in (0, 100):
        out = timeline.previous_in_key(df, ["k"], "at", {"id": "p", "v": "pv"}, ["id"], max_rows=max_rows)
        assert {r["id"]: (r["p"], r["pv"]) for r in out.collect()} == {1: (None, None), 2: (1, None)}


def test_crowded_names_only_hot_keys(spark):
    df = spark.createDataFrame([(1,)] * 5 + [(None,)] * 4 + [(2,)], "k int")
    assert rows(timeline.crowded(df, ["k"], 4)) == [(1,)]
    assert rows(timeline.crowded(df, ["k"], 3)) == [(1,), (None,)]
    assert timeline.crowded(df, ["k"], 5) is None and timeline.crowded(df.limit(0), ["k"]) is None


@pytest.mark.parametrize("seed", [3, 4])
@pytest.mark.parametrize("max_rows", [0, 40, 1000])
def test_running_and_rolling(spark, seed, max_rows):
    data = make(seed)
    df = spark.createDataFrame(data, DDL)
    width = timedelta(hours=5)
    rowwise = timeline.running_total(df, ["k"], "at", "v", "s", ["id"], width=width, max_rows=max_rows)
    peers = timeline.running_total(df, ["k"], "at", "v", "s", peers=True, width=width, max_rows=max_rows)
    rolled = timeline.rolling_sum(df, ["k"], "at", "v", timedelta(days=1), "s", width=width, max_rows=max_rows)
    want_row, want_peer, want_roll = {}, {}, {}
    for seq in by_key(data).values():
        cents = [round(r[3] * 100) for r in seq]
        for i, r in enumerate(seq):
            want_row[r[2]] = sum(cents[: i + 1]) / 100
            want_peer[r[2]] = sum(c for c, o in zip(cents, seq) if o[1] <= r[1]) / 100
            now = r[1].replace(microsecond=0)
            inside = [c for c, o in zip(cents, seq) if now - timedelta(days=1) <= o[1].replace(microsecond=0) <= now]
            want_roll[r[2]] = sum(inside) / 100
    balanced = timeline.rolling_sum(df, ["k"], "at", "v", timedelta(days=1), "s", width=width, slide=True)
    for df_out, want in ((rowwise, want_row), (peers, want_peer), (rolled, want_roll), (balanced, want_roll)):
        assert {r["id"]: r["s"] for r in df_out.collect()} == want


@pytest.mark.parametrize("seed", [5, 6, 7])
def test_sessions(spark, seed):
    data = make(seed, 300)
    gap = timedelta(minutes=45)
    want = []
    label = {}
    for k, seq in by_key(data).items():
        runs = []
        for r in seq:
            if runs and r[1] - runs[-1][-1][1] <= gap:
                runs[-1].append(r)
            else:
                runs.append([r])
        for run in runs:
            want.append((k, run[0][1], run[-1][1], len(run), sum(round(r[3] * 100) for r in run)))
            label.update({r[2]: run[0][1] for r in run})
    df = spark.createDataFrame(data, DDL).withColumn("cents", F.round(F.col("v") * 100).cast("bigint"))
    for tag in ("number", "start"):
        got = timeline.gap_sessions(df, ["k"], "at", gap, {"cents": ("sum", "cents")}, tag)
        same(got, want, "k int, session_start timestamp_ntz, session_end timestamp_ntz, n_events bigint, cents bigint")
    native = timeline.native_sessions(df, ["k"], "at", gap)
    assert rows(native) == rows(spark.createDataFrame([w[:4] for w in want], native.schema))
    keyed = df.filter("k IS NOT NULL")
    for max_rows in (1, 1000):
        tagged = timeline.label_sessions(keyed, ["k"], "at", gap, max_rows=max_rows)
        assert {r["id"]: r["session_start"] for r in tagged.collect()} == {
            r[2]: label[r[2]] for r in data if r[0] is not None
        }


def test_session_boundary_is_exact(spark):
    at = ["08:00:00", "08:30:00", "09:00:00.500000", "09:00:00.500000"]
    df = spark.createDataFrame([("u", ts(f"2025-05-01 {a}")) for a in at], "u string, at timestamp_ntz")
    want = [
        ("u", ts("2025-05-01 08:00:00"), ts("2025-05-01 08:30:00"), 2),
        ("u", ts("2025-05-01 09:00:00.500000"), ts("2025-05-01 09:00:00.500000"), 2),
    ]
    ddl = "u string, session_start timestamp_ntz, session_end timestamp_ntz, n_events bigint"
    same(timeline.gap_sessions(df, ["u"], "at", timedelta(minutes=30)), want, ddl)
    same(timeline.native_sessions(df, ["u"], "at", timedelta(minutes=30)), want, ddl)


def test_time_delta_starts_at_zero(spark):
    data = [("u", ts("2025-01-01 23:59:30"), "a"), ("u", ts("2025-01-02 00:00:10"), "b"), ("v", ts("2025-01-02 05:00:00"), "c")]
    df = spark.createDataFrame(data, "u string, at timestamp_ntz, id string")
    got = timeline.time_delta(df, ["u"], "at", ["id"])
    assert {r["id"]: r["delta_s"] for r in got.collect()} == {"a": 0, "b": 40, "c": 0}


def test_longest_streak(spark):
    days = ["2025-02-27", "2025-02-28", "2025-03-01", "2025-03-01", "2025-03-03", "2025-03-04"]
    data = [(7, day(d)) for d in days] + [(8, day("2025-01-01"))]
    got = timeline.longest_streak(spark.createDataFrame(data, "u int, d date"), ["u"], "d")
    same(got, [(7, 3), (8, 1)], "u int, longest_streak bigint")


def sparse(spark):
    data = [
        ("a", day("2025-06-01"), 10.0),
        ("a", day("2025-06-02"), -4.0),
        ("a", day("2025-06-03"), 6.0),
        ("a", day("2025-06-09"), 70.0),
        ("b", day("2025-06-03"), 5.55),
    ]
    return spark.createDataFrame(data, "s string, d date, v double")


def test_trailing_average_routes_agree(spark):
    df = sparse(spark)
    frame = timeline.trailing_avg(df, ["s"], "d", "v", 7, "ma")
    dense = timeline.dense_trailing_avg(df, ["s"], "d", "v", 7, "ma")
    want = {("a", 1): 1.43, ("a", 2): 0.86, ("a", 3): 1.71, ("a", 9): 10.86, ("b", 3): 0.79}
    for got in (frame, dense):
        assert {(r["s"], r["d"].day): r["ma"] for r in got.collect()} == want


def test_previous_day_three_ways(spark):
    df = sparse(spark)
    framed = timeline.value_at_offset(df, ["s"], "d", "v", -1, "p")
    order = W.partitionBy("s").orderBy("d")
    lagged = df.withColumn(
        "p",
        F.when(F.datediff("d", F.lag("d").over(order)) == 1, F.lag("v").over(order)).otherwise(F.lit(0.0)),
    )
    before = df.select("s", F.date_add("d", 1).alias("d"), F.col("v").alias("p"))
    joined = df.join(before, ["s", "d"], "left").withColumn("p", F.coalesce("p", F.lit(0.0)))
    assert rows(framed) == rows(lagged) == rows(joined)


def test_versions(spark):
    feed = [
        ("p", day("2025-01-01"), "toys", 40.0),
        ("p", day("2025-01-03"), "toys", 40.0),
        ("p", day("2025-01-04"), "toys", None),
        ("p", day("2025-01-05"), "toys", None),
        ("p", day("2025-02-09"), "toys", 40.0),
        ("q", day("2025-01-02"), "food", 1.0),
    ]
    df = spark.createDataFrame(feed, "p string, at date, cat string, price double")
    want = [
        ("p", day("2025-01-01"), "toys", 40.0, day("2025-01-04"), False),
        ("p", day("2025-01-04"), "toys", None, day("2025-02-09"), False),
        ("p", day("2025-02-09"), "toys", 40.0, None, True),
        ("q", day("2025-01-02"), "food", 1.0, None, True),
    ]
    for max_rows in (0, 2, 100):
        got = timeline.versions(df, ["p"], "at", ["cat", "price"], width=timedelta(days=2), max_rows=max_rows)
        same(got, want, "p string, effective_from date, cat string, price double, effective_to date, is_current boolean")


@pytest.mark.parametrize("seed", [8, 9])
@pytest.mark.parametrize("max_rows", [0, 50, 1000])
def test_last_known(spark, seed, max_rows):
    r = random.Random(seed)
    facts = make(seed, 150)
    history = [(r.choice([1, 1, 2, None]), BASE + timedelta(minutes=15 * r.randrange(600)), i) for i in range(60)]
    f = spark.createDataFrame(facts, DDL)
    h = spark.createDataFrame(history, "k int, since timestamp_ntz, hid int")
    got = timeline.last_known(f, h, ["k"], "at", "since", ["hid"], ["hid"], timedelta(hours=7), max_rows)
    want = {}
    for k, at, i, _ in facts:
        seen = [(s, hid) for hk, s, hid in history if hk is not None and hk == k and s <= at]
        want[i] = max(seen)[1] if seen else None
    assert {x["id"]: x["hid"] for x in got.collect()} == want


def test_top_n_with_ties(spark):
    data = [("d", "ann", 90), ("d", "bob", 80), ("d", "cy", 80), ("d", "di", 70), ("e", "ed", 5), ("e", "flo", None)]
    df = spark.createDataFrame(data, "g string, n string, v int")

    def names(rank, n):
        spread = ranking.top_n(df, ["g"], "v", n, rank=rank, max_rows=1)
        plain = ranking.top_n(df, ["g"], "v", n, rank=rank)
        assert rows(spread) == rows(plain)
        return {(r["n"], r["rnk"]) for r in plain.collect()}

    assert names("dense", 2) == {("ann", 1), ("bob", 2), ("cy", 2), ("ed", 1)}
    assert names("rank", 3) == {("ann", 1), ("bob", 2), ("cy", 2), ("ed", 1)}
    assert names("rank", 4) == {("ann", 1), ("bob", 2), ("cy", 2), ("di", 4), ("ed", 1)}
    assert {n for n, _ in names("row", 1)} == {"ann", "ed"}


def test_keep_latest_never_depends_on_row_order(spark):
    data = [(1, "a", 2.0, "2025-01-01 10:00", 5), (1, "b", 3.0, "2025-01-01 10:00", 6), (1, "b", 3.0, "2025-01-01 10:00", 6), (2, "c", None, "2025-01-01 09:00", 1), (2, "d", 1.0, "2025-01-01 09:00", 1)]
    ddl = "id int, n string, p double, at string, seq int"
    a = spark.createDataFrame(data, ddl)
    b = spark.createDataFrame(data[::-1], ddl).repartition(3)
    want = [(1, "b", 3.0, "2025-01-01 10:00", 6), (2, "d", 1.0, "2025-01-01 09:00", 1)]
    for df in (a, b):
        same(ranking.keep_latest(df, ["id"], ["at", "seq"]), want, ddl)
        counted = ranking.keep_latest_counted(df, ["id"], ["at", "seq"])
        same(counted, [(*want[0], 3), (*want[1], 2)], ddl + ", n_versions bigint")


def test_argbest(spark):
    data = [("u", "x", 3), ("u", "y", 3), ("u", "z", None), ("w", "q", None)]
    df = spark.createDataFrame(data, "u string, name string, n int")
    got = ranking.argbest(df, ["u"], [-F.col("n"), F.col("name")], ["name"], how="min")
    same(got, [("u", "x")], "u string, name string")
    full = ranking.argbest_or_default(df, ["u"], [-F.col("n"), F.col("name")], ["name"], df.select("u").distinct(), ["UNKNOWN"], "min")
    same(full, [("u", "x"), ("w", "UNKNOWN")], "u string, name string")


def test_date_axis(spark):
    from millrace.sources.tables import date_axis, number_axis

    want = [(date(2024, 2, 28),), (date(2024, 2, 29),), (date(2024, 3, 1),)]
    same(date_axis(spark, date(2024, 2, 28), date(2024, 3, 1)), want, "d date")
    same(number_axis(spark, 3, date(2024, 2, 28)), want, "d date")
