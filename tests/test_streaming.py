"""Streams run to the end of the available data, against their batch twins."""

import json
import os
import random
from datetime import datetime, timedelta

from helpers import rows, same, ts
import pytest
from pyspark.sql import functions as F

from millrace.operators.timeline import gap_sessions
from millrace.operators.upserts import apply_changes
from millrace.plans.facts import resolve_trips
from millrace.session import shared_dir
from millrace.sources.tables import json_stream, parquet_stream
from millrace.streaming import accounted, sinks, windows

SALE = "order_id string, event_time timestamp, amount double"


def land(folder, name, lines, at):
    """One JSON file with a fixed modification time: files are read in that order."""
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w") as f:
        f.write("\n".join(json.dumps(line) for line in lines))
    os.utime(path, (at, at))


def sale(order, at, amount):
    return {"order_id": order, "event_time": f"2025-02-01 {at}", "amount": amount}


def sales_folder(tmp_path):
    folder = str(tmp_path / "sales")
    land(folder, "a.json", [sale("1", "10:01:00", 1.1), sale("2", "10:09:59", 2.2), sale("3", "10:10:00", 5.0)], 1000)
    land(folder, "b.json", [sale("4", "11:00:00", 7.0)], 2000)
    land(folder, "c.json", [sale("5", "11:01:00", 1.0)], 3000)
    land(folder, "d.json", [sale("late", "10:02:00", 100.0), sale("ok", "10:55:00", 3.0)], 4000)
    return folder


def opened(df):
    return windows.open_window(df).withColumns(
        {c: F.date_format(c, "HH:mm") for c in ("window_start", "window_end")}
    )


def test_append_emits_closed_windows_and_drops_late_rows(spark, tmp_path):
    stream = json_stream(spark, sales_folder(tmp_path), SALE, files_per_batch=1)
    got = sinks.run_append(windows.open_window(windows.tumbling_sales(stream)), shared_dir(spark, "t"))
    closed = got.select(F.date_format("window_start", "HH:mm").alias("s"), "total_sales", "order_count")
    assert rows(closed) == [("10:00", 3.3, 2), ("10:10", 5.0, 1)]


def test_update_keeps_the_last_state_of_every_window(spark, tmp_path):
    for build in (windows.tumbling_sales, windows.tumbling_sales_sql):
        stream = json_stream(spark, sales_folder(tmp_path), SALE, files_per_batch=1)
        got = sinks.run_updates(
            windows.open_window(build(stream)), shared_dir(spark, "t"), ["window_start", "window_end"]
        )
        seen = got.select(F.date_format("window_start", "HH:mm").alias("s"), "total_sales", "order_count")
        assert rows(seen) == [("10:00", 3.3, 2), ("10:10", 5.0, 1), ("10:50", 3.0, 1), ("11:00", 8.0, 2)]


def test_one_batch_equals_the_batch_query(spark, tmp_path):
    folder = sales_folder(tmp_path)
    stream = json_stream(spark, folder, SALE)
    got = sinks.run_updates(opened(windows.tumbling_sales(stream)), shared_dir(spark, "t"), ["window_start"])
    batch = opened(windows.tumbling_sales(spark.read.schema(SALE).json(folder)))
    assert rows(got) == rows(batch)


def test_dedup_within_watermark(spark, tmp_path):
    folder = str(tmp_path / "feed")
    land(folder, "a.json", [{"id": "x1", "k": 1, "t": "2025-02-01 10:00:00"}, {"id": "x2", "k": 2, "t": "2025-02-01 10:00:00"}], 1000)
    land(folder, "b.json", [{"id": "x3", "k": 1, "t": "2025-02-01 10:00:00"}, {"id": "x4", "k": 1, "t": "2025-02-01 10:00:01"}], 2000)
    stream = json_stream(spark, folder, "id string, k int, t timestamp", files_per_batch=1)
    got = sinks.run_append(windows.dedup_stream(stream, ["k", "t"], "t", "1 hour"), shared_dir(spark, "t"))
    assert rows(got.select("id")) == [("x1",), ("x2",), ("x4",)]


def test_rolling_users_exact_and_streamed(spark):
    data = [("p", "u1", ts("2025-01-08 23:59:59")), ("p", "u1", ts("2025-01-09 00:00:00")), ("p", "u2", ts("2025-01-15 00:00:00"))]
    df = spark.createDataFrame(data, "url string, u string, t timestamp_ntz")
    exact = windows.rolling_uv(df, "url", "t", "u")
    direct = df.groupBy("url", F.window("t", "7 days", "1 day").alias("w")).agg(F.count_distinct("u").alias("n"))
    assert rows(exact) == rows(direct.select("url", "w.start", "w.end", "n"))
    path = shared_dir(spark, "t")
    df.withColumn("t", F.col("t").cast("timestamp")).write.parquet(path)
    stream = parquet_stream(spark, path, "url string, u string, t timestamp")
    users = windows.rolling_uv_stream(stream, "url", "t", "u")
    got = sinks.run_updates(users, shared_dir(spark, "t"), ["url", "window_start", "window_end"])
    assert rows(got.select("url", "rolling_uv")) == rows(exact.select("url", "rolling_uv"))


def test_upserts_by_batch_remember_deletes(spark, tmp_path):
    folder = str(tmp_path / "changes")
    land(folder, "a.json", [{"k": 1, "op": "U", "v": "b", "at": "05"}, {"k": 2, "op": "D", "at": "06"}, {"k": 3, "op": "I", "v": "n", "at": "01"}], 1000)
    land(folder, "b.json", [{"k": 1, "op": "U", "v": "old", "at": "04"}, {"k": 2, "op": "U", "v": "stale", "at": "05"}, {"k": 1, "op": "U", "v": "c", "at": "07"}], 2000)
    ddl = "k int, op string, v string, at string"
    seed = spark.createDataFrame([(1, "a", "02"), (2, "a", "02")], "k int, v string, at string")
    root = shared_dir(spark, "t")
    for _ in range(2):
        sinks.run_upserts(json_stream(spark, folder, ddl, files_per_batch=1), root, ["k"], ["v"], "at")
        got = sinks.upserted(spark, seed, root, ["k"], ["v"], "at")
        same(got, [(1, "c", "07"), (3, "n", "01")], "k int, v string, at string")
    twin = apply_changes(seed, spark.read.schema(ddl).json(folder), ["k"], ["v"], "at")
    assert rows(twin) == rows(got)
    folded = shared_dir(spark, "t")
    land(folder, "c.json", [{"k": 3, "op": "D", "at": "02"}], 3000)
    for _ in range(2):
        sinks.run_upserts(json_stream(spark, folder, ddl, files_per_batch=1), folded, ["k"], ["v"], "at", compact_every=2)
        got = sinks.upserted(spark, seed, folded, ["k"], ["v"], "at")
        same(got, [(1, "c", "07")], "k int, v string, at string")
    assert spark.read.parquet(f"{folded}/base").select("upto").distinct().count() == 1


def test_streams_without_data(spark, tmp_path):
    folder = str(tmp_path / "empty")
    os.makedirs(folder)
    sales = windows.open_window(windows.tumbling_sales(json_stream(spark, folder, SALE)))
    assert sinks.run_append(sales, shared_dir(spark, "t")).count() == 0
    assert sinks.run_updates(sales, shared_dir(spark, "t"), ["window_start"]).count() == 0
    root = shared_dir(spark, "t")
    seed = spark.createDataFrame([(1, "a", "02")], "k int, v string, at string")
    sinks.run_upserts(json_stream(spark, folder, "k int, op string, v string, at string"), root, ["k"], ["v"], "at")
    assert rows(sinks.upserted(spark, seed, root, ["k"], ["v"], "at")) == rows(seed)
    ddl = "trip_id string, driver_id string, completed_ts string, fare_cents bigint, first_seen_date string"
    drivers = spark.createDataFrame([], "driver_id string, fleet_id string")
    commissions = spark.createDataFrame([], "fleet_id string, commission_pct int")
    got = sinks.run_resolution(json_stream(spark, folder, ddl), shared_dir(spark, "t"), lambda s: (drivers, commissions))
    assert got.count() == 0


def test_park_and_replay(spark, tmp_path):
    folder = str(tmp_path / "trips")

    def trip(i, driver):
        return {"trip_id": i, "driver_id": driver, "completed_ts": "2025-01-01 10:00:00", "fare_cents": 1000, "first_seen_date": "2025-01-02"}

    land(folder, "a.json", [trip("t1", "a"), trip("t2", "b")], 1000)
    land(folder, "b.json", [trip("t3", "a"), trip("t4", "zz")], 2000)
    ddl = "trip_id string, driver_id string, completed_ts string, fare_cents bigint, first_seen_date string"
    commissions = spark.createDataFrame([("f", 20)], "fleet_id string, commission_pct int")
    calls = []

    def dims(session):
        """The second driver is onboarded between the first batch and the second."""
        calls.append(1)
        known = [("a", "f")] + ([("b", "f")] if len(calls) > 1 else [])
        return session.createDataFrame(known, "driver_id string, fleet_id string"), commissions

    got = sinks.run_resolution(json_stream(spark, folder, ddl, files_per_batch=1), shared_dir(spark, "t"), dims)
    assert {(r["trip_id"], r["load_status"], r["driver_earning_cents"]) for r in got.collect()} == {
        ("t1", "PUBLISHED", 800),
        ("t2", "PUBLISHED", 800),
        ("t3", "PUBLISHED", 800),
        ("t4", "PENDING", None),
    }
    assert len(calls) >= 2
    everything = resolve_trips(spark.read.schema(ddl).json(folder), *dims(spark))
    assert rows(everything.select("trip_id", "load_status")) == rows(got.select("trip_id", "load_status"))


def test_resent_trips_null_ids_and_a_restart(spark, tmp_path):
    folder, root = str(tmp_path / "trips"), shared_dir(spark, "t")

    def trip(i, driver, fare=1000):
        return {"trip_id": i, "driver_id": driver, "completed_ts": "2025-01-01 10:00:00", "fare_cents": fare, "first_seen_date": "2025-01-02"}

    ddl = "trip_id string, driver_id string, completed_ts string, fare_cents bigint, first_seen_date string"
    commissions = spark.createDataFrame([("f", 20)], "fleet_id string, commission_pct int")
    known = {"a"}

    def dims(session):
        return session.createDataFrame([(d, "f") for d in sorted(known)], "driver_id string, fleet_id string"), commissions

    def broken(session):
        raise RuntimeError("lost in the middle of a batch")

    def run(source):
        return sinks.run_resolution(json_stream(spark, folder, ddl, files_per_batch=1), root, source)

    land(folder, "a.json", [trip("t1", "a"), trip("t1", "a"), trip("t2", "b"), trip(None, "b")], 1000)
    first = run(dims)
    assert rows(first.select("trip_id", "load_status")) == rows(spark.createDataFrame([(None, "PENDING"), ("t1", "PUBLISHED"), ("t2", "PENDING")], "a string, b string"))
    land(folder, "b.json", [trip("t1", "a", 7), trip("t2", "b", 7), trip(None, "a")], 2000)
    calls = []

    def fails_once(session):
        calls.append(1)
        return broken(session) if len(calls) == 2 else dims(session)

    with pytest.raises(Exception, match="lost in the middle"):
        run(fails_once)
    known.add("b")
    for _ in range(2):
        got = run(dims)
        assert rows(got.select("trip_id", "load_status", "driver_earning_cents")) == rows(
            spark.createDataFrame([(None, "PUBLISHED", 800), (None, "PUBLISHED", 800), ("t1", "PUBLISHED", 800), ("t2", "PUBLISHED", 800)], "a string, b string, c bigint")
        )


def test_tumbling_accounts_for_what_spark_drops(spark, tmp_path):
    folder = sales_folder(tmp_path)
    land(folder, "e.json", [{"order_id": "none", "amount": 1.0}], 5000)
    minutes = lambda n: timedelta(minutes=n)
    stream = json_stream(spark, folder, SALE, files_per_batch=1)
    found = accounted.run_tumbling(stream, shared_dir(spark, "t"), "event_time", "amount", minutes(10), minutes(20))
    own = json_stream(spark, folder, SALE, files_per_batch=1).filter("event_time IS NOT NULL")
    spark_s = sinks.run_updates(windows.open_window(windows.tumbling_sales(own)), shared_dir(spark, "t"), ["window_start", "window_end"])
    clock = lambda c: F.date_format(c, "HH:mm").alias(c)
    ours = found.rows.select(clock("window_start"), clock("window_end"), "total", "n")
    assert rows(ours) == rows(spark_s.select(clock("window_start"), clock("window_end"), "total_sales", "order_count"))
    assert rows(found.late.select("order_id", "reason")) == [("late", "behind the watermark"), ("none", "no time")]
    assert all(r["n_in"] == r["n_late"] + r["n_counted"] for r in found.accounts.collect())
    assert found.accounts.agg(F.sum("n_in"), F.sum("n_late")).first() == (8, 2)


VISIT = "id int, k string, at timestamp"


def visits(seed, n=240):
    """Files whose rows come in disorder: near ones, some far behind, some between two sessions that are open."""
    r, out = random.Random(seed), []
    for f in range(6):
        for i in range(n // 6):
            minute = f * 60 + r.randrange(60) - (r.choice([0, 0, 0, 15, 90, 200]))
            out.append((f, {"id": len(out), "k": r.choice("ab"), "at": str(datetime(2025, 2, 1, 12) + timedelta(minutes=minute, seconds=r.choice([0, 30])))}))
    return out


def in_order(folder, sent):
    for f in sorted({f for f, _ in sent}):
        land(folder, f"{f}.json", [v for g, v in sent if g == f], 1000 + f)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_sessions_on_a_stream_are_those_of_the_rows_on_time(spark, tmp_path, seed):
    folder, root = str(tmp_path / "visits"), shared_dir(spark, "s")
    sent = visits(seed)
    in_order(folder, sent)
    gap, lateness = timedelta(minutes=7), timedelta(minutes=40)
    found = accounted.run_sessions(json_stream(spark, folder, VISIT, files_per_batch=1), root, ["k"], "at", gap, lateness)
    late, top = set(), None
    for f in range(6):
        mine = [v for g, v in sent if g == f]
        late |= {v["id"] for v in mine if top and ts(v["at"]) < top - lateness}
        top = max([ts(v["at"]) for v in mine] + ([top] if top else []))
    assert late and {r["id"] for r in found.late.collect()} == late
    on_time = spark.createDataFrame([(v["id"], v["k"], ts(v["at"])) for _, v in sent if v["id"] not in late], "id int, k string, at timestamp_ntz")
    want = gap_sessions(on_time, ["k"], "at", gap).select("k", "session_start", "session_end", F.col("n_events").alias("n"))
    assert rows(found.rows) == rows(want)
    closed = spark.read.parquet(f"{root}/closed")
    assert closed.count() > 0 and rows(closed.select(*want.columns).exceptAll(want)) == []


def test_a_late_row_joins_two_open_sessions_and_a_lost_batch_changes_nothing(spark, tmp_path, monkeypatch):
    folder, root = str(tmp_path / "visits"), shared_dir(spark, "s")
    base = datetime(2025, 2, 1, 12)
    visit = lambda i, minute: {"id": i, "k": "a", "at": str(base + timedelta(minutes=minute))}
    land(folder, "0.json", [visit(0, 0), visit(1, 12)], 1000)
    land(folder, "1.json", [visit(2, 6)], 2000)
    land(folder, "2.json", [visit(3, 300), visit(4, 1)], 3000)
    land(folder, "3.json", [visit(5, 2)], 4000)

    def go():
        stream = json_stream(spark, folder, VISIT, files_per_batch=1)
        return accounted.run_sessions(stream, root, ["k"], "at", timedelta(minutes=7), timedelta(minutes=30))

    honest, calls = accounted.check, []

    def fails(df, gates):
        calls.append(1)
        if len(calls) == 3:
            raise RuntimeError("lost in the middle")
        return honest(df, gates)

    monkeypatch.setattr(accounted, "check", fails)
    with pytest.raises(Exception, match="lost in the middle"):
        go()
    monkeypatch.setattr(accounted, "check", honest)
    for _ in range(2):
        found = go()
        assert rows(found.rows.select("session_start", "session_end", "n")) == [
            (base, base + timedelta(minutes=12), 4),
            (base + timedelta(minutes=300), base + timedelta(minutes=300), 1),
        ]
        assert [r["id"] for r in found.late.collect()] == [5]
        assert rows(found.accounts.select("batch", "n_in", "n_late", "n_counted")) == [(0, 2, 0, 2), (1, 1, 0, 1), (2, 2, 0, 2), (3, 1, 1, 0)]


def test_accounts_of_a_stream_without_data(spark, tmp_path):
    folder = str(tmp_path / "none")
    os.makedirs(folder)
    found = accounted.run_sessions(json_stream(spark, folder, VISIT), shared_dir(spark, "s"), ["k"], "at", timedelta(minutes=7), timedelta(hours=1))
    assert found.rows.count() == found.late.count() == found.accounts.count() == 0


def test_a_batch_of_trips_reads_its_own_landing_only(spark, tmp_path):
    """Which ids were seen is state: what older landings hold now makes no difference."""
    folder, root = str(tmp_path / "trips"), shared_dir(spark, "t")
    trip = lambda i, fare: {"trip_id": i, "driver_id": "a", "completed_ts": "2025-01-01 10:00:00", "fare_cents": fare, "first_seen_date": "2025-01-02"}
    ddl = "trip_id string, driver_id string, completed_ts string, fare_cents bigint, first_seen_date string"

    def dims(session):
        return session.createDataFrame([("a", "f")], "driver_id string, fleet_id string"), session.createDataFrame([("f", 20)], "fleet_id string, commission_pct int")

    land(folder, "a.json", [trip("t1", 1000), trip("t1", 900)], 1000)
    sinks.run_resolution(json_stream(spark, folder, ddl, files_per_batch=1), root, dims)
    other = spark.createDataFrame([("t2", "a", "x", 1, "y")], ddl)
    other.write.mode("overwrite").parquet(f"{root}/landed/batch=0")
    land(folder, "b.json", [trip("t1", 5), trip("t2", 2000)], 2000)
    got = sinks.run_resolution(json_stream(spark, folder, ddl, files_per_batch=1), root, dims)
    assert rows(got.select("trip_id", "driver_earning_cents")) == [("t1", 720), ("t2", 1600)]
    assert rows(spark.read.schema(ddl).parquet(f"{root}/landed/batch=1").select("trip_id")) == [("t2",)]
