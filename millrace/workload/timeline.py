"""Sessions, streaks, neighbours, rolling sums and versions over events and orders."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from ..functions.values import exact_sum, major, minor
from ..operators import ranking, skew, timeline
from ..plans import facts, reports, serving
from ..session import materialise
from ..sources.tables import sql
from .registry import Given, query

SIX_HOURS = timedelta(hours=6)
DAY = timedelta(days=1)

# Shared beginning of the session twins: events of a user cut where more than six hours pass.
_RUNS = """
WITH flagged AS (
  SELECT *, CASE WHEN lag(ts) OVER w IS NULL OR ts - lag(ts) OVER w > INTERVAL 6 HOUR THEN 1 ELSE 0 END AS opens
  FROM {source} WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
), runs AS (
  SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS seq
  FROM flagged
)
"""


@query(
    "app_sessions",
    _RUNS.format(source="(SELECT * FROM events WHERE event_type <> 'error')")
    + """, sessions AS (
  SELECT user_id, seq, min(ts) AS s, max(ts) AS e, count(*) AS n FROM runs GROUP BY ALL
)
SELECT CAST(user_id AS VARCHAR) || '-' || strftime(s, '%Y%m%d%H%M%S') AS session_id,
       CAST(user_id AS VARCHAR) AS device_id,
       coalesce(d.platform, 'UNKNOWN') AS platform,
       strftime(s, '%Y-%m-%d') AS session_date,
       strftime(s, '%Y-%m-%d %H:%M:%S') AS session_start_ts,
       strftime(e, '%Y-%m-%d %H:%M:%S') AS session_end_ts,
       n AS n_events,
       epoch_us(e) // 1000000 - epoch_us(s) // 1000000 AS duration_sec
FROM sessions LEFT JOIN (
  SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'iOS' WHEN 1 THEN 'Android' ELSE 'Web' END AS platform
  FROM customer WHERE c_custkey % 5 <> 0
) d ON d.c_custkey = user_id
""",
)
def app_sessions(t: Given):
    events = t.events.select(
        "event_id",
        F.col("user_id").cast("string").alias("device_id"),
        F.col("ts").alias("event_ts"),
        F.col("event_type").alias("event_name"),
    )
    names = t.events.select(F.col("event_type").alias("event_name")).distinct()
    catalog = materialise(names.withColumn("is_engagement", F.col("event_name") != "error"))
    kind = F.col("c_custkey") % 3
    devices = t.customer.filter(F.col("c_custkey") % 5 != 0).select(
        F.col("c_custkey").cast("string").alias("device_id"),
        F.when(kind == 0, "iOS").when(kind == 1, "Android").otherwise("Web").alias("platform"),
    )
    return facts.app_sessions(events, catalog, devices, SIX_HOURS)


@query(
    "sessions_running_max",
    _RUNS.format(source="events")
    + """
SELECT user_id, min(ts) AS session_start, max(ts) AS session_end, count(*) AS n_events,
       CAST(sum(CAST(value AS DECIMAL(18, 2))) AS DOUBLE) AS total
FROM runs GROUP BY user_id, seq
""",
)
def sessions_running_max(t: Given):
    events = t.events.select("user_id", "ts", minor("value").alias("cents"))
    found = timeline.gap_sessions(events, ["user_id"], "ts", SIX_HOURS, {"cents": ("sum", "cents")}, "start")
    return found.withColumn("total", major(F.col("cents"))).drop("cents")


@query(
    "session_window_builtin",
    _RUNS.format(source="events")
    + """
SELECT user_id, min(ts) AS session_start, max(ts) AS session_end, count(*) AS n_events
FROM runs GROUP BY user_id, seq
""",
)
def session_window_builtin(t: Given):
    return timeline.native_sessions(t.events.select("user_id", "ts"), ["user_id"], "ts", SIX_HOURS)


@query(
    "session_labels",
    _RUNS.format(source="events")
    + """
SELECT event_id, user_id, ts, min(ts) OVER (PARTITION BY user_id, seq) AS session_start FROM runs
""",
)
def session_labels(t: Given):
    return timeline.label_sessions(t.events.select("event_id", "user_id", "ts"), ["user_id"], "ts", SIX_HOURS)


@query(
    "login_streak",
    """
WITH days AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS d FROM events),
numbered AS (
  SELECT user_id, d - CAST(row_number() OVER (PARTITION BY user_id ORDER BY d) AS INTEGER) AS island FROM days
), runs AS (SELECT user_id, island, count(*) AS n FROM numbered GROUP BY ALL)
SELECT user_id, max(n) AS longest_streak FROM runs GROUP BY user_id
""",
)
def login_streak(t: Given):
    return timeline.longest_streak(t.events, ["user_id"], "ts")


@query(
    "order_streak",
    """
WITH days AS (SELECT DISTINCT o_custkey, CAST(o_orderdate AS DATE) AS d FROM orders),
numbered AS (
  SELECT o_custkey, d - CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY d) AS INTEGER) AS island FROM days
), runs AS (SELECT o_custkey, island, count(*) AS n FROM numbered GROUP BY ALL)
SELECT o_custkey, max(n) AS longest_streak FROM runs GROUP BY o_custkey
""",
)
def order_streak(t: Given):
    return timeline.longest_streak(t.orders, ["o_custkey"], "o_orderdate")


@query(
    "user_journey",
    """
WITH once AS (
  SELECT event_id, user_id, ts AS click_time FROM events
), seen AS (
  SELECT *, lag(click_time) OVER (PARTITION BY user_id ORDER BY click_time, event_id) AS prev FROM once
)
SELECT event_id, user_id, click_time,
       coalesce(epoch_us(click_time) // 1000000 - epoch_us(prev) // 1000000, 0) AS time_diff_sec
FROM seen
""",
)
def user_journey(t: Given):
    clicks = t.events.select("event_id", "user_id", F.col("ts").alias("click_time"))
    replayed = clicks.filter(F.col("event_id") % 10 == 0).withColumn(
        "click_time", F.col("click_time") - F.expr("INTERVAL 5 MINUTES")
    )
    return reports.user_journey(clicks.unionByName(replayed))


@query(
    "next_event",
    """
SELECT event_id, user_id, ts,
       lead(event_type) OVER w AS next_type, lead(event_id) OVER w AS next_id
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
""",
)
def next_event(t: Given):
    events = t.events.select("event_id", "user_id", "ts", "event_type")
    near = timeline.next_in_key(
        events, ["user_id"], "ts", {"event_type": "next_type", "event_id": "next_id"}, ["event_id"], DAY
    )
    return near.drop("event_type")


@query(
    "store_trend",
    """
WITH daily AS (
  SELECT CAST(user_id AS VARCHAR) AS store_id, CAST(ts AS DATE) AS sale_date,
         CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents
  FROM events WHERE event_type = 'purchase' GROUP BY ALL
), framed AS (
  SELECT store_id, sale_date, cents,
    CAST(sum(cents) OVER (PARTITION BY store_id ORDER BY sale_date
      RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW) AS BIGINT) AS week,
    coalesce(CAST(max(cents) OVER (PARTITION BY store_id ORDER BY sale_date
      RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING) AS BIGINT), 0) AS prev
  FROM daily
)
SELECT store_id, sale_date, cents / 100.0 AS revenue,
       ((2 * week + 7) // 14) / 100.0 AS ma7,
       prev / 100.0 AS prev_day_revenue,
       CASE WHEN prev <> 0 THEN
         CASE WHEN cents >= prev THEN ((cents - prev) * 20000 + prev) // (2 * prev)
              ELSE -(((prev - cents) * 20000 + prev) // (2 * prev)) END / 100.0 END AS dod_growth_pct
FROM framed
""",
)
def store_trend(t: Given):
    daily = (
        t.events.filter(F.col("event_type") == "purchase")
        .groupBy(
            F.col("user_id").cast("string").alias("store_id"), F.col("ts").cast("date").alias("sale_date")
        )
        .agg(exact_sum("value").alias("revenue"))
    )
    return serving.store_trend(daily)


def _daily_users(t: Given):
    return t.events.groupBy("user_id", F.col("ts").cast("date").alias("day")).agg(
        exact_sum("value").alias("spent")
    )


_DAILY = """
WITH daily AS (
  SELECT user_id, CAST(ts AS DATE) AS day, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents
  FROM events GROUP BY ALL
)
"""


@query(
    "dense_trailing",
    _DAILY
    + """, framed AS (
  SELECT *, CAST(sum(cents) OVER (PARTITION BY user_id ORDER BY day
    RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW) AS BIGINT) AS week FROM daily
)
SELECT user_id, day, cents / 100.0 AS spent, ((2 * week + 7) // 14) / 100.0 AS ma7 FROM framed
""",
)
def dense_trailing(t: Given):
    return timeline.dense_trailing_avg(_daily_users(t), ["user_id"], "day", "spent", 7, "ma7")


@query(
    "trailing_avg",
    _DAILY
    + """, framed AS (
  SELECT *, CAST(sum(cents) OVER (PARTITION BY user_id ORDER BY day
    RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW) AS BIGINT) AS week FROM daily
)
SELECT user_id, day, cents / 100.0 AS spent, ((2 * week + 7) // 14) / 100.0 AS ma7 FROM framed
""",
)
def trailing_avg(t: Given):
    return timeline.trailing_avg(_daily_users(t), ["user_id"], "day", "spent", 7, "ma7")


@query(
    "prev_day_value",
    _DAILY
    + """
SELECT a.user_id, a.day, a.cents / 100.0 AS spent, coalesce(b.cents, 0) / 100.0 AS prev_day
FROM daily a LEFT JOIN daily b ON b.user_id = a.user_id AND b.day = a.day - 1
""",
)
def prev_day_value(t: Given):
    return timeline.value_at_offset(_daily_users(t), ["user_id"], "day", "spent", -1, "prev_day")


@query(
    "rolling_7d",
    """
SELECT event_id, user_id, ts,
       CAST(sum(CAST(value AS DECIMAL(18, 2))) OVER (
         PARTITION BY user_id ORDER BY epoch_us(ts) // 1000000
         RANGE BETWEEN 604800 PRECEDING AND CURRENT ROW) AS DOUBLE) AS rolling_7d_spend
FROM events
""",
)
def rolling_7d(t: Given):
    events = t.events.select("event_id", "user_id", "ts", "value")
    rolled = timeline.rolling_sum(
        events, ["user_id"], "ts", "value", timedelta(days=7), "rolling_7d_spend", width=DAY
    )
    return rolled.drop("value")


@query(
    "running_balance",
    """
SELECT event_id, user_id,
       CAST(sum(CAST(value AS DECIMAL(18, 2))) OVER (
         PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS balance
FROM events
""",
)
def running_balance(t: Given):
    events = t.events.select("event_id", "user_id", "ts", "value")
    total = timeline.running_total(events, ["user_id"], "ts", "value", "balance", ["event_id"], width=DAY)
    return total.select("event_id", "user_id", "balance")


@query(
    "running_balance_peers",
    """
SELECT o_orderkey, o_custkey,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) OVER (
         PARTITION BY o_custkey ORDER BY o_orderdate) AS DOUBLE) AS balance
FROM orders
""",
)
def running_balance_peers(t: Given):
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    total = timeline.running_total(
        orders, ["o_custkey"], "o_orderdate", "o_totalprice", "balance", peers=True, width=timedelta(days=90)
    )
    return total.select("o_orderkey", "o_custkey", "balance")


@query(
    "scd2_history",
    """
WITH feed AS (
  SELECT user_id, ts, event_id, event_type, CASE WHEN event_id % 9 = 0 THEN NULL ELSE value >= 20 END AS big
  FROM events
), seen AS (
  SELECT *, lag(ts) OVER w AS prev_ts, lag(event_type) OVER w AS prev_type, lag(big) OVER w AS prev_big
  FROM feed WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
), starts AS (
  SELECT * FROM seen
  WHERE prev_ts IS NULL OR event_type IS DISTINCT FROM prev_type OR big IS DISTINCT FROM prev_big
), closed AS (
  SELECT *, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS effective_to FROM starts
)
SELECT user_id, ts AS effective_from, effective_to, event_type, big, effective_to IS NULL AS is_current
FROM closed
""",
)
def scd2_history(t: Given):
    feed = t.events.select(
        "user_id",
        "ts",
        "event_id",
        "event_type",
        F.when(F.col("event_id") % 9 != 0, F.col("value") >= 20).alias("big"),
    )
    return timeline.versions(feed, ["user_id"], "ts", ["event_type", "big"], ["event_id"], DAY)


@query(
    "product_history",
    """
WITH feed AS (
  SELECT l_partkey AS product_id, l_shipdate AS changed_at, min(l_returnflag) AS category,
         min(CASE WHEN l_linenumber % 3 <> 0 THEN l_quantity END) AS price
  FROM lineitem GROUP BY ALL
), seen AS (
  SELECT *, lag(changed_at) OVER w AS prev_at, lag(category) OVER w AS prev_category, lag(price) OVER w AS prev_price
  FROM feed WINDOW w AS (PARTITION BY product_id ORDER BY changed_at)
), starts AS (
  SELECT * FROM seen WHERE prev_at IS NULL OR category IS DISTINCT FROM prev_category OR price IS DISTINCT FROM prev_price
)
SELECT product_id, changed_at AS effective_from, lead(changed_at) OVER w AS effective_to, category, price,
       lead(changed_at) OVER w IS NULL AS is_current
FROM starts WINDOW w AS (PARTITION BY product_id ORDER BY changed_at)
""",
)
def product_history(t: Given):
    feed = t.lineitem.groupBy(F.col("l_partkey").alias("product_id"), F.col("l_shipdate").alias("changed_at")).agg(
        F.min("l_returnflag").alias("category"), F.min(F.when(F.col("l_linenumber") % 3 != 0, F.col("l_quantity"))).alias("price")
    )
    return serving.product_history(feed)


@query(
    "fine_running_total",
    """
SELECT event_id, CAST(sum(CAST(event_id % 100000 AS DECIMAL(38, 0))) OVER (PARTITION BY user_id ORDER BY ts, event_id) / 100000 AS DOUBLE) AS total
FROM events
""",
)
def fine_running_total(t: Given):
    """Five decimals by declaration."""
    fine = t.events.select("event_id", "user_id", "ts", ((F.col("event_id") % 100000) / 1e5).alias("fine"))
    return timeline.running_total(fine, ["user_id"], "ts", "fine", "total", ["event_id"], scale=5).select("event_id", "total")


@query(
    "last_known_view",
    """
WITH views AS (SELECT user_id, ts, event_id, value FROM events WHERE event_type = 'view'),
buys AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase')
SELECT b.event_id, b.user_id, b.ts, v.value AS view_value, v.event_id AS view_id
FROM buys b ASOF LEFT JOIN views v ON v.user_id = b.user_id AND v.ts <= b.ts
""",
)
def last_known_view(t: Given):
    views = t.events.filter(F.col("event_type") == "view").select(
        "user_id",
        F.col("ts").alias("seen_at"),
        F.col("value").alias("view_value"),
        F.col("event_id").alias("view_id"),
    )
    buys = t.events.filter(F.col("event_type") == "purchase").select("event_id", "user_id", "ts")
    return timeline.last_known(
        buys, views, ["user_id"], "ts", "seen_at", ["view_value", "view_id"], ["view_id"], DAY
    )


# ---------------------------------------------------------------- a third of all events on one user


def _folded(t: Given):
    user = F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id"))
    events = t.events.withColumn("user_id", user.cast("bigint"))
    return events, skew.hot_keys(events, "user_id", share=0.05)


_FOLDED = """
WITH folded AS (SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END AS user_id) FROM events)
"""


@query(
    "skewed_next_event",
    _FOLDED
    + """
SELECT event_id, user_id, lead(event_type) OVER w AS next_type, lag(event_id) OVER w AS prev_id
FROM folded WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
""",
)
def skewed_next_event(t: Given):
    events, hot = _folded(t)
    slim = events.select("event_id", "user_id", "ts", "event_type")
    near = timeline.next_in_key(slim, ["user_id"], "ts", {"event_type": "next_type"}, ["event_id"], hot=hot)
    both = timeline.previous_in_key(near, ["user_id"], "ts", {"event_id": "prev_id"}, ["event_id"], hot=hot)
    return both.select("event_id", "user_id", "next_type", "prev_id")


@query(
    "skewed_rolling_7d",
    _FOLDED
    + """
SELECT event_id, user_id,
       CAST(sum(CAST(value AS DECIMAL(18, 2))) OVER (
         PARTITION BY user_id ORDER BY epoch_us(ts) // 1000000
         RANGE BETWEEN 604800 PRECEDING AND CURRENT ROW) AS DOUBLE) AS rolling_7d_spend
FROM folded
""",
)
def skewed_rolling_7d(t: Given):
    events, hot = _folded(t)
    slim = events.select("event_id", "user_id", "ts", "value")
    rolled = timeline.rolling_sum(
        slim, ["user_id"], "ts", "value", timedelta(days=7), "rolling_7d_spend", hot=hot
    )
    return rolled.select("event_id", "user_id", "rolling_7d_spend")


@query(
    "skewed_running_balance",
    _FOLDED
    + """
SELECT event_id, user_id,
       CAST(sum(CAST(value AS DECIMAL(18, 2))) OVER (
         PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS balance
FROM folded
""",
)
def skewed_running_balance(t: Given):
    events, hot = _folded(t)
    slim = events.select("event_id", "user_id", "ts", "value")
    total = timeline.running_total(slim, ["user_id"], "ts", "value", "balance", ["event_id"], hot=hot)
    return total.select("event_id", "user_id", "balance")


@query(
    "skewed_last_known",
    _FOLDED
    + """
, views AS (SELECT user_id, ts, value FROM folded WHERE event_type = 'view')
SELECT b.event_id, b.user_id, v.value AS view_value
FROM (SELECT * FROM folded WHERE event_type = 'purchase') b
ASOF LEFT JOIN views v ON v.user_id = b.user_id AND v.ts <= b.ts
""",
)
def skewed_last_known(t: Given):
    events, hot = _folded(t)
    views = events.filter(F.col("event_type") == "view").select(
        "user_id", F.col("ts").alias("seen_at"), F.col("value").alias("view_value")
    )
    buys = events.filter(F.col("event_type") == "purchase").select("event_id", "user_id", "ts")
    return timeline.last_known(
        buys, views, ["user_id"], "ts", "seen_at", ["view_value"], ["view_value"], hot=hot
    ).drop("ts")


@query(
    "keep_latest_order",
    """
SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice, o_orderdate
FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
""",
)
def keep_latest_order(t: Given):
    orders = t.orders.drop("o_orderpriority")
    return ranking.keep_latest(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])


@query(
    "current_catalog",
    """
SELECT l_partkey AS product_id, CAST(l_suppkey AS VARCHAR) AS product_name, l_extendedprice AS price,
       strftime(l_shipdate, '%Y-%m-%d %H:%M') AS updated_at,
       count(*) OVER (PARTITION BY l_partkey) AS n_versions
FROM lineitem QUALIFY row_number() OVER (
  PARTITION BY l_partkey ORDER BY l_shipdate DESC, l_orderkey * 8 + l_linenumber DESC,
  CAST(l_suppkey AS VARCHAR) DESC, l_extendedprice DESC) = 1
""",
)
def current_catalog(t: Given):
    updates = t.lineitem.select(
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").cast("string").alias("product_name"),
        F.col("l_extendedprice").alias("price"),
        F.date_format("l_shipdate", "yyyy-MM-dd HH:mm").alias("updated_at"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("source_seq"),
    )
    return serving.current_catalog(updates)


@query(
    "top_customers",
    """
SELECT n_name, c_custkey, c_acctbal, rnk FROM (
  SELECT n_name, c_custkey, c_acctbal,
         CAST(dense_rank() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC) AS INTEGER) AS rnk
  FROM customer JOIN nation ON n_nationkey = c_nationkey
) WHERE rnk <= 3
""",
)
def top_customers(t: Given):
    best = ranking.top_n(t.customer.select("c_custkey", "c_nationkey", "c_acctbal"), ["c_nationkey"], "c_acctbal", 3)
    named = best.join(t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name"), "c_nationkey")
    return named.select("n_name", "c_custkey", "c_acctbal", "rnk")


@query(
    "top_quantity_rank",
    """
SELECT l_orderkey, l_linenumber, l_suppkey, l_quantity, rnk FROM (
  SELECT *, CAST(rank() OVER (PARTITION BY l_suppkey ORDER BY l_quantity DESC) AS INTEGER) AS rnk FROM lineitem
) WHERE rnk <= 20
""",
)
def top_quantity_rank(t: Given):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity")
    return ranking.top_n(lines, ["l_suppkey"], "l_quantity", 20, rank="rank")


@query(
    "top_orders_row",
    """
SELECT o_orderkey, o_custkey, o_totalprice,
       CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey DESC) AS INTEGER) AS rnk
FROM orders QUALIFY rnk <= 2
""",
)
def top_orders_row(t: Given):
    orders = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    return ranking.top_n(orders, ["o_custkey"], "o_totalprice", 2, rank="row", ties=["o_orderkey"])


@query(
    "best_known_offer",
    """
SELECT l_partkey, l_suppkey, price FROM (
  SELECT l_partkey, l_suppkey, CASE WHEN l_orderkey % 3 <> 0 THEN l_extendedprice END AS price FROM lineitem
) WHERE price IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY price, l_suppkey) = 1
""",
)
def best_known_offer(t: Given):
    offers = t.lineitem.select(
        "l_partkey", "l_suppkey", F.when(F.col("l_orderkey") % 3 != 0, F.col("l_extendedprice")).alias("price")
    )
    order = [F.col("price").asc(), F.col("l_suppkey").asc()]
    return ranking.best_known(offers, ["l_partkey"], order, "price")


@query(
    "null_ordering",
    """
SELECT l_partkey, l_suppkey, price FROM (
  SELECT l_partkey, l_suppkey, l_orderkey, l_linenumber,
         CASE WHEN l_orderkey % 3 <> 0 THEN l_extendedprice END AS price FROM lineitem
) QUALIFY row_number() OVER (
  PARTITION BY l_partkey ORDER BY price ASC NULLS LAST, l_orderkey DESC, l_linenumber DESC) = 1
""",
)
def null_ordering(t: Given):
    offers = t.lineitem.select(
        "l_partkey",
        "l_suppkey",
        "l_orderkey",
        "l_linenumber",
        F.when(F.col("l_orderkey") % 3 != 0, F.col("l_extendedprice")).alias("price"),
    )
    kept = ranking.keep_latest(
        offers, ["l_partkey"], [F.col("price").asc_nulls_last(), "l_orderkey", "l_linenumber"]
    )
    return kept.select("l_partkey", "l_suppkey", "price")


@query(
    "named_window_sql",
    """
SELECT user_id, day, spent,
       CAST(sum(spent) OVER w AS DOUBLE) AS so_far, count(*) OVER w AS n_days
FROM (SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS spent FROM events GROUP BY ALL)
WINDOW w AS (PARTITION BY user_id ORDER BY day ROWS UNBOUNDED PRECEDING)
""",
)
def named_window_sql(t: Given):
    days = t.events.groupBy("user_id", F.col("ts").cast("date").alias("day")).agg(
        F.count(F.lit(1)).alias("spent")
    )
    return sql(
        t.spark,
        """
        SELECT user_id, day, spent, CAST(sum(spent) OVER w AS DOUBLE) AS so_far, count(*) OVER w AS n_days
        FROM {days}
        WINDOW w AS (PARTITION BY user_id ORDER BY day ROWS UNBOUNDED PRECEDING)
        """,
        days=days,
    )
