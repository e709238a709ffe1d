"""Sources, layouts, snapshots, materialisation and streams, each over data derived from the tables."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from ..functions.values import exact_sum
from ..operators import joins, quality, states
from ..plans import reports
from ..session import materialise, shared_dir
from ..sources import layout, snapshots
from ..sources.tables import date_axis, json_stream
from ..streaming import accounted, sinks, windows
from .incremental import PAYOUTS, payout_dims, trips
from .registry import Given, query

_SENSORS = """
WITH daily AS (
  SELECT event_type AS sensor_type, strftime(ts, '%Y-%m-%d') AS date, user_id AS device_id,
         CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents, count(*) AS n
  FROM events WHERE value BETWEEN 0 AND 120 GROUP BY ALL
)
"""


def _readings(t: Given):
    return t.events.select(
        F.col("user_id").alias("device_id"),
        F.col("event_type").alias("sensor_type"),
        F.col("ts").alias("timestamp"),
        F.col("value").alias("reading"),
    )


@query(
    "partition_write",
    _SENSORS + "SELECT sensor_type, date, device_id, (2 * cents + n) // (2 * n) / 100.0 AS avg_reading FROM daily",
)
def partition_write(t: Given):
    path = shared_dir(t.spark, "sensor_daily")
    reports.publish_sensor_daily(_readings(t), path)
    ddl = "device_id bigint, avg_reading double, sensor_type string, date string"
    return t.spark.read.schema(ddl).parquet(path)


@query(
    "partition_census",
    _SENSORS + "SELECT sensor_type, date, CAST(1 AS BIGINT) AS n_files, count(*) AS n_rows FROM daily GROUP BY ALL",
)
def partition_census(t: Given):
    path = shared_dir(t.spark, "sensor_census")
    reports.publish_sensor_daily(_readings(t), path)
    census = layout.partition_census(t.spark, path, ["sensor_type", "date"])
    return census.withColumn("date", F.col("date").cast("string"))


@query(
    "partition_spread",
    """
SELECT l_returnflag, true AS bounded, count(*) AS n_rows FROM lineitem GROUP BY ALL
""",
)
def partition_spread(t: Given):
    path = shared_dir(t.spark, "lines")
    lines = t.lineitem.select("l_orderkey", "l_quantity", "l_returnflag")
    layout.write_partitioned(lines, path, ["l_returnflag"], spread="l_orderkey", files_per_folder=4)
    census = layout.partition_census(t.spark, path, ["l_returnflag"])
    return census.select("l_returnflag", (F.col("n_files") <= 4).alias("bounded"), "n_rows")


_AUDIT = """
SELECT p_partkey AS product_id,
       CASE WHEN p_partkey % 21 <> 0 THEN round(p_retailprice + CASE WHEN p_partkey % 10 = 0 THEN 501 ELSE -105 END, 2) END
         AS current_price,
       p_retailprice AS original_price,
       CASE WHEN p_partkey % 21 <> 0 THEN CAST(CASE WHEN p_partkey % 10 = 0 THEN 501 ELSE -105 END AS DOUBLE) END AS price_diff
FROM part WHERE p_partkey % 10 = 0 OR p_partkey % 15 = 1 OR p_partkey % 21 = 0
"""


@query("snapshot_diff", _AUDIT.replace("ELSE -105", "WHEN p_partkey % 15 = 1 THEN -105 ELSE 0"))
def snapshot_diff(t: Given):
    root, key = shared_dir(t.spark, "products"), F.col("p_partkey")
    original = t.part.select(key.alias("product_id"), F.col("p_retailprice").alias("price"))
    shift = F.when(key % 10 == 0, 501).when(key % 15 == 1, -105).otherwise(0)
    broken = t.part.select(
        key.alias("product_id"),
        F.when(key % 21 != 0, F.round(F.col("p_retailprice") + shift, 2)).alias("price"),
    )
    ddl = "product_id bigint, price double"
    snapshots.write_version(original, root, 0)
    snapshots.write_version(broken, root, 1)
    latest = snapshots.read_version(t.spark, root, 1, ddl)
    return reports.price_audit(latest, snapshots.read_version(t.spark, root, 0, ddl))


_FORK = """
WITH per_customer AS (
  SELECT o_custkey, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS total FROM orders GROUP BY ALL
), ranked AS (SELECT n, count(*) AS customers FROM per_customer GROUP BY ALL)
SELECT o_custkey, n, total, customers FROM per_customer JOIN ranked USING (n)
"""


def _fork(t: Given, how: str):
    per_customer = materialise(
        t.orders.groupBy("o_custkey").agg(
            F.count(F.lit(1)).alias("n"), exact_sum("o_totalprice").alias("total")
        ),
        how,
    )
    same_n = per_customer.groupBy("n").agg(F.count(F.lit(1)).alias("customers"))
    return per_customer.join(same_n, "n")


@query("materialised_table", _FORK)
def materialised_table(t: Given):
    return _fork(t, "table")


@query("materialised_persist", _FORK)
def materialised_persist(t: Given):
    return _fork(t, "persist")


@query("materialised_checkpoint", _FORK)
def materialised_checkpoint(t: Given):
    return _fork(t, "checkpoint")


@query(
    "calendar_report",
    """
SELECT CAST(d AS DATE) AS d, count(o_orderkey) AS n_orders
FROM (SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS d FROM orders)
LEFT JOIN orders ON o_orderdate = d GROUP BY ALL
""",
)
def calendar_report(t: Given):
    ends = quality.measure(t.orders, {"first": F.min("o_orderdate"), "last": F.max("o_orderdate")})
    axis = date_axis(t.spark, ends["first"].date(), ends["last"].date())
    daily = t.orders.groupBy(F.col("o_orderdate").cast("date").alias("d")).agg(F.count(F.lit(1)).alias("n_orders"))
    return joins.enrich(axis, daily, "d", {"n_orders": 0})


# ---------------------------------------------------------------- streams


def _landed(t: Given, df, label: str) -> str:
    """A directory of JSON files, as a collector would leave it."""
    path = shared_dir(t.spark, label)
    df.write.json(path)
    return path


def _sales_stream(t: Given):
    sales = t.events.filter(F.col("event_type") == "purchase").select(
        F.col("event_id").cast("string").alias("order_id"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("event_time"),
        F.col("value").alias("amount"),
    )
    ddl = "order_id string, event_time timestamp, amount double"
    return json_stream(t.spark, _landed(t, sales, "sales"), ddl)


_TUMBLING = """
SELECT CAST(time_bucket(INTERVAL 10 MINUTE, ts) AS VARCHAR)[1:19] AS window_start,
       CAST(time_bucket(INTERVAL 10 MINUTE, ts) + INTERVAL 10 MINUTE AS VARCHAR)[1:19] AS window_end,
       CAST(sum(CAST(value AS DECIMAL(18, 2))) AS DOUBLE) AS total_sales, count(*) AS order_count
FROM events WHERE event_type = 'purchase' GROUP BY 1, 2
"""


def _texts(df):
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("window_start", "window_end")})


@query(
    "tumbling_sales",
    _TUMBLING
    + """
HAVING window_end <= (SELECT CAST(max(ts) - INTERVAL 20 MINUTE AS VARCHAR)[1:19] FROM events WHERE event_type = 'purchase')
""",
)
def tumbling_sales(t: Given):
    """Append mode: only windows the watermark has closed."""
    closed = windows.open_window(windows.tumbling_sales(_sales_stream(t)))
    return _texts(sinks.run_append(closed, shared_dir(t.spark, "tumbling")))


@query("tumbling_sales_sql", _TUMBLING)
def tumbling_sales_sql(t: Given):
    """Update mode: every window, as last seen."""
    every = windows.open_window(windows.tumbling_sales_sql(_sales_stream(t)))
    return _texts(sinks.run_updates(every, shared_dir(t.spark, "tumbling_sql"), ["window_start", "window_end"]))


@query(
    "rolling_uv",
    """
WITH days AS (SELECT DISTINCT event_type, CAST(ts AS DATE) AS d, user_id FROM events),
spread AS (SELECT event_type, user_id, d - CAST(i AS INTEGER) AS s FROM days, (SELECT unnest(range(7)) AS i))
SELECT event_type AS url, CAST(s AS TIMESTAMP) AS window_start, CAST(s + 7 AS TIMESTAMP) AS window_end,
       count(DISTINCT user_id) AS rolling_uv
FROM spread GROUP BY ALL
""",
)
def rolling_uv(t: Given):
    clicks = t.events.select(F.col("event_type").alias("url"), "user_id", "ts")
    return windows.rolling_uv(clicks, "url", "ts", "user_id").orderBy("url", "window_start")


@query(
    "rolling_uv_states",
    """
WITH days AS (SELECT DISTINCT event_type, CAST(ts AS DATE) AS d, user_id FROM events),
spread AS (SELECT event_type, user_id, d - CAST(i AS INTEGER) AS s FROM days, (SELECT unnest(range(7)) AS i))
SELECT event_type AS url, CAST(s AS TIMESTAMP) AS window_start, CAST(s + 7 AS TIMESTAMP) AS window_end,
       count(DISTINCT user_id) AS rolling_uv, true AS near_exact
FROM spread GROUP BY ALL
""",
)
def rolling_uv_states(t: Given):
    """Weeks of users from stored days.  Two loads, by the parity of the hour, each read their events once and add their
    states to the store; the report reads states only."""
    day, week = timedelta(days=1), timedelta(days=7)
    path, keys = shared_dir(t.spark, "uv_states"), ["url", "slide"]
    for load in (0, 1):
        some = t.events.filter(F.hour("ts") % 2 == load).select(F.col("event_type").alias("url"), "user_id", states.slide_of("ts", day))
        states.bitmap_states(some, keys, "user_id").write.parquet(f"{path}/bitmaps/load={load}")
        states.sketch_states(some, keys, "user_id").write.parquet(f"{path}/sketches/load={load}")
    grain = ["url", "window_start", "window_end"]
    bitmaps = states.bitmap_union(t.spark.read.parquet(f"{path}/bitmaps"), keys)
    sketches = states.sketch_union(t.spark.read.parquet(f"{path}/sketches"), keys)
    exact = states.bitmap_counts(states.windows_of(bitmaps, week, day), grain, "rolling_uv")
    likely = states.sketch_counts(states.windows_of(sketches, week, day), grain, "likely")
    # Three standard errors of 2 ** 12 registers, and at least one user.
    near = F.abs(F.col("likely") - F.col("rolling_uv")) <= F.greatest(F.lit(1.0), 3 * 1.04 / 64 * F.col("rolling_uv"))
    return exact.join(likely, grain, "full_outer").select(*grain, "rolling_uv", F.coalesce(near, F.lit(False)).alias("near_exact"))


@query(
    "rolling_uv_stream",
    """
WITH days AS (SELECT DISTINCT event_type, CAST(ts AS DATE) AS d, user_id FROM events),
spread AS (SELECT event_type, user_id, d - CAST(i AS INTEGER) AS s FROM days, (SELECT unnest(range(7)) AS i))
SELECT event_type AS url, CAST(s AS TIMESTAMP) AS window_start, CAST(s + 7 AS TIMESTAMP) AS window_end,
       count(DISTINCT user_id) AS exact_uv, true AS near_exact
FROM spread GROUP BY ALL
""",
)
def rolling_uv_stream(t: Given):
    clicks = t.events.select(
        F.col("event_type").alias("url"), "user_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts")
    )
    stream = json_stream(t.spark, _landed(t, clicks, "clicks"), "url string, user_id bigint, ts timestamp")
    users = windows.rolling_uv_stream(stream, "url", "ts", "user_id")
    grain = ["url", "window_start", "window_end"]
    sketched = sinks.run_updates(users, shared_dir(t.spark, "rolling"), grain)
    sketched = sketched.withColumns({c: F.col(c).cast("timestamp_ntz") for c in grain[1:]})
    exact = rolling_uv(t).withColumnRenamed("rolling_uv", "exact_uv")
    # Three standard errors of the sketch, and at least one user.
    off = F.abs(F.col("rolling_uv") - F.col("exact_uv"))
    near = F.coalesce(off <= F.greatest(F.lit(1.0), 3 * 0.05 * F.col("exact_uv")), F.lit(False))
    return exact.join(sketched, grain, "full_outer").select(*grain, "exact_uv", near.alias("near_exact"))


@query(
    "dedup_stream",
    "SELECT user_id, CAST(ts AS VARCHAR)[1:19] AS at FROM events GROUP BY user_id, ts",
)
def dedup_stream(t: Given):
    """At-least-once feed: resent messages carry a new id but the same payload key."""
    sent = t.events.select("event_id", "user_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"))
    resent = sent.filter(F.col("event_id") % 10 == 0).withColumn("event_id", -F.col("event_id") - 1)
    path = _landed(t, sent.unionByName(resent), "feed")
    stream = json_stream(t.spark, path, "event_id bigint, user_id bigint, ts timestamp")
    once = windows.dedup_stream(stream, ["user_id", "ts"], "ts", "1 hour")
    found = sinks.run_append(once.select("user_id", "ts"), shared_dir(t.spark, "dedup"))
    return found.select("user_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("at"))


@query(
    "upsert_stream",
    """
WITH both_sides AS (
  SELECT c_custkey AS k, 'S' AS op, c_mktsegment AS plan, '1998-01-01' AS seen, 1 AS held FROM customer
  UNION ALL
  SELECT o_custkey, CASE WHEN o_orderkey % 10 = 0 THEN 'D' ELSE 'U' END,
         CASE WHEN o_orderkey % 10 <> 0 THEN o_orderpriority END, strftime(o_orderdate, '%Y-%m-%d'), 0
  FROM orders
), last AS (
  SELECT * FROM both_sides
  QUALIFY row_number() OVER (PARTITION BY k ORDER BY seen DESC, held DESC, op DESC, plan DESC NULLS LAST) = 1
)
SELECT k, plan, seen FROM last WHERE op <> 'D'
""",
)
def upsert_stream(t: Given):
    gone = F.col("o_orderkey") % 10 == 0
    changes = t.orders.select(
        F.col("o_custkey").alias("k"),
        F.when(gone, "D").otherwise("U").alias("op"),
        F.when(~gone, F.col("o_orderpriority")).alias("plan"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("seen"),
    )
    path = _landed(t, changes.repartition(4, "k"), "changes")
    stream = json_stream(t.spark, path, "k bigint, op string, plan string, seen string", files_per_batch=2)
    seed = t.customer.select(
        F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("plan"), F.lit("1998-01-01").alias("seen")
    )
    root = shared_dir(t.spark, "upserts")
    sinks.run_upserts(stream, root, ["k"], ["plan"], "seen")
    return sinks.upserted(t.spark, seed, root, ["k"], ["plan"], "seen")


@query(
    "resolve_stream",
    PAYOUTS.format(first_seen="strftime(o_orderdate, '%Y-%m-%d')").replace(
        "CAST(o_orderkey AS VARCHAR) AS trip_id", "CASE WHEN o_orderkey % 13 <> 0 THEN CAST(o_orderkey AS VARCHAR) END AS trip_id"
    ),
)
def resolve_stream(t: Given):
    """Some trips are sent twice, some have no id, and a quarter of the drivers is known from the second batch on."""
    sent = trips(t).withColumn("trip_id", F.when(F.col("o_orderkey") % 13 != 0, F.col("trip_id"))).drop("o_orderkey")
    again = sent.filter(F.col("trip_id").endswith("1"))
    path = _landed(t, sent.unionByName(again).repartition(4), "trips")
    ddl = "trip_id string, driver_id string, completed_ts string, fare_cents bigint, first_seen_date string"
    stream = json_stream(t.spark, path, ddl, files_per_batch=2)
    asked = []

    def dims(session):
        asked.append(1)  # once for the schema, then once per batch
        drivers, commissions = payout_dims(Given(session, t.folder))
        if len(asked) <= 2:
            drivers = drivers.filter(F.col("driver_id").cast("bigint") % 4 != 1)
        return drivers, commissions

    return sinks.run_resolution(stream, shared_dir(t.spark, "payouts"), dims)


_STRAGGLERS = """
WITH sent AS (
  SELECT *, CASE WHEN event_id % 97 = 0 THEN 3 WHEN ts < TIMESTAMP '2024-01-12' THEN 1 ELSE 2 END AS load FROM events
), marks AS (
  SELECT 1 AS load, TIMESTAMP '0001-01-01' AS mark
  UNION ALL SELECT 2, max(ts) - INTERVAL 3 DAY FROM sent WHERE load = 1
  UNION ALL SELECT 3, max(ts) - INTERVAL 3 DAY FROM sent WHERE load < 3
), judged AS (
  SELECT s.*, mark, ts < mark AS late FROM sent s JOIN marks USING (load)
)
"""


def _straggling(t: Given) -> accounted.Accounted:
    """The events in three loads, the last one of stragglers from all times, as sessions with three days of lateness."""
    load = F.when(F.col("event_id") % 97 == 0, 3).when(F.col("ts") < F.lit("2024-01-12").cast("timestamp_ntz"), 1).otherwise(2)
    sent = t.events.select("event_id", "user_id", F.col("ts").cast("timestamp_ntz").alias("at"), load.alias("load"))
    path = shared_dir(t.spark, "loads")
    for i in (1, 2, 3):
        # One batch is one load: as many files each, later loads written later.
        sent.filter(F.col("load") == i).drop("load").repartition(2, "user_id").write.mode("append").parquet(path)
    stream = t.spark.readStream.schema("event_id bigint, user_id bigint, at timestamp_ntz").option("maxFilesPerTrigger", 2).parquet(path)
    return accounted.run_sessions(stream, shared_dir(t.spark, "sessions"), ["user_id"], "at", timedelta(hours=6), timedelta(days=3))


@query(
    "session_stream",
    _STRAGGLERS
    + """, steps AS (
  SELECT *, CASE WHEN ts - lag(ts) OVER w <= INTERVAL 6 HOUR THEN 0 ELSE 1 END AS opens FROM judged WHERE NOT late
  WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
), tagged AS (
  SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session FROM steps
)
SELECT user_id, min(ts) AS session_start, max(ts) AS session_end, count(*) AS n FROM tagged GROUP BY user_id, session
""",
)
def session_stream(t: Given):
    return _straggling(t).rows


@query(
    "late_rows",
    _STRAGGLERS + "SELECT event_id, user_id, ts AS at, mark AS watermark, 'behind the watermark' AS reason FROM judged WHERE late",
)
def late_rows(t: Given):
    return _straggling(t).late.select("event_id", "user_id", "at", "watermark", "reason")


@query(
    "late_accounts",
    _STRAGGLERS + "SELECT load, count(*) AS n_in, count(*) FILTER (late) AS n_late, count(*) FILTER (NOT late) AS n_counted FROM judged GROUP BY load",
)
def late_accounts(t: Given):
    return _straggling(t).accounts.select((F.col("batch") + 1).cast("int").alias("load"), "n_in", "n_late", "n_counted")
