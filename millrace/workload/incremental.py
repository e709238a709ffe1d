"""The complete jobs, and the upserts, interval joins and splits they are made of."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.values import exact_sum
from ..operators import intervals, joins
from ..plans import facts, serving
from ..session import materialise
from .registry import Given, TWINS, query

# ---------------------------------------------------------------- subscriptions


def _subscription_inputs(t: Given):
    current = t.customer.select(
        F.col("c_custkey").cast("string").alias("subscription_id"),
        F.when(F.col("c_custkey") % 2 == 0, "3-MEDIUM").otherwise("5-LOW").alias("plan"),
        F.lit("ACTIVE").alias("status"),
        F.col("c_acctbal").alias("mrr"),
        F.lit("1998-01-01 00:00:00").alias("updated_at"),
    )
    kind = F.col("o_orderkey") % 10
    gone = kind == 0
    changes = t.orders.select(
        F.when(F.col("o_orderkey") % 17 == 0, F.concat(F.lit("new-"), F.col("o_orderkey")))
        .otherwise(F.col("o_custkey").cast("string"))
        .alias("subscription_id"),
        F.when(gone, "D").when(kind == 1, "I").otherwise("U").alias("op"),
        F.when(~gone, F.col("o_orderpriority")).alias("plan"),
        F.when(~gone, F.col("o_orderstatus")).alias("status"),
        F.when(~gone, F.col("o_totalprice")).alias("mrr"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("change_ts"),
    )
    plans = t.orders.select(F.col("o_orderpriority").alias("plan")).distinct()
    return current, changes, materialise(plans.withColumn("mrr", F.length("plan") * F.lit(1.5)))


_SUBSCRIPTIONS = """
WITH both_sides AS (
  SELECT CAST(c_custkey AS VARCHAR) AS subscription_id, 'S' AS op,
         CASE WHEN c_custkey % 2 = 0 THEN '3-MEDIUM' ELSE '5-LOW' END AS plan, 'ACTIVE' AS status,
         '1998-01-01 00:00:00' AS updated_at, 1 AS held
  FROM customer
  UNION ALL
  SELECT CASE WHEN o_orderkey % 17 = 0 THEN 'new-' || o_orderkey ELSE CAST(o_custkey AS VARCHAR) END,
         CASE o_orderkey % 10 WHEN 0 THEN 'D' WHEN 1 THEN 'I' ELSE 'U' END,
         CASE WHEN o_orderkey % 10 <> 0 THEN o_orderpriority END,
         CASE WHEN o_orderkey % 10 <> 0 THEN o_orderstatus END,
         strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'), 0
  FROM orders
), last AS (
  SELECT * FROM both_sides QUALIFY row_number() OVER (PARTITION BY subscription_id
    ORDER BY updated_at DESC, held DESC, op DESC, plan DESC NULLS LAST, status DESC NULLS LAST) = 1
)
SELECT subscription_id, plan, status, CAST(length(plan) * 1.5 AS DOUBLE) AS mrr, updated_at
FROM last WHERE op <> 'D'
"""


@query("cdc_upsert", _SUBSCRIPTIONS)
def cdc_upsert(t: Given):
    return serving.subscriptions(*_subscription_inputs(t))


@query("cdc_upsert_outer", _SUBSCRIPTIONS)
def cdc_upsert_outer(t: Given):
    return serving.subscriptions(*_subscription_inputs(t), route="outer")


@query(
    "scd1_upsert",
    """
WITH both_sides AS (
  SELECT c_custkey AS customer_id, c_name AS email, c_mktsegment AS tier, TIMESTAMP '1997-06-01' AS updated_at
  FROM customer
  UNION ALL
  SELECT o_custkey, 'order-' || o_orderkey, o_orderpriority, o_orderdate FROM orders
)
SELECT * FROM both_sides
QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY updated_at DESC, email DESC, tier DESC) = 1
""",
)
def scd1_upsert(t: Given):
    history = t.customer.select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("email"),
        F.col("c_mktsegment").alias("tier"),
        F.lit("1997-06-01").cast("timestamp_ntz").alias("updated_at"),
    )
    delta = t.orders.select(
        F.col("o_custkey").alias("customer_id"),
        F.concat(F.lit("order-"), F.col("o_orderkey")).alias("email"),
        F.col("o_orderpriority").alias("tier"),
        F.col("o_orderdate").alias("updated_at"),
    )
    return serving.customer_snapshot(history, delta)


@query(
    "merge_states",
    """
WITH placed AS (SELECT o_custkey AS k, count(*) AS n FROM orders WHERE o_orderstatus = 'P' GROUP BY ALL),
held AS (SELECT c_custkey AS k, CAST(0 AS BIGINT) AS n FROM customer WHERE c_acctbal >= 0)
SELECT coalesce(p.k, h.k) AS k, coalesce(p.n, h.n) AS n,
       CASE WHEN p.k IS NULL THEN 'old' WHEN h.k IS NULL THEN 'new' ELSE 'both' END AS origin
FROM placed p FULL OUTER JOIN held h ON h.k = p.k
""",
)
def merge_states(t: Given):
    new = (
        t.orders.filter(F.col("o_orderstatus") == "P")
        .groupBy(F.col("o_custkey").alias("k"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    old = t.customer.filter(F.col("c_acctbal") >= 0).select(
        F.col("c_custkey").alias("k"), F.lit(0).cast("bigint").alias("n")
    )
    return joins.merge_states(old, new, ["k"], ["n"])


# ---------------------------------------------------------------- effective-dated regions

_ASSIGNED = """
WITH assigned AS (
  SELECT c_custkey AS k, 'R' || c_nationkey AS region, '1995-06-01' AS valid_from,
         CASE WHEN c_custkey % 3 <> 0 THEN '1998-01-01' END AS valid_to FROM customer WHERE c_custkey % 8 <> 0
  UNION ALL
  SELECT c_custkey, 'R' || (c_nationkey + 1), '1998-01-01', NULL FROM customer WHERE c_custkey % 8 <> 0
  UNION ALL
  SELECT c_custkey, 'PROMO', '1999-01-01', '1999-07-01' FROM customer WHERE c_custkey % 4 = 1
  UNION ALL
  SELECT c_custkey, 'LATE', '1999-01-01', '9999-12-31' FROM customer WHERE c_custkey % 12 = 1
  UNION ALL
  SELECT c_custkey, 'ALSO', '1999-01-01', '9999-12-31' FROM customer WHERE c_custkey % 24 = 1
), sellers AS (
  SELECT *, CASE WHEN o_orderkey % 17 <> 0 THEN o_custkey END AS seller FROM orders
)
"""


def _assigned(t: Given):
    base = t.customer.select(F.col("c_custkey").cast("string").alias("seller_id"), "c_custkey", "c_nationkey")
    named = base.filter(F.col("c_custkey") % 8 != 0)
    first = named.select(
        "seller_id",
        F.concat(F.lit("R"), F.col("c_nationkey")).alias("region"),
        F.lit("1995-06-01").alias("valid_from"),
        F.when(F.col("c_custkey") % 3 != 0, "1998-01-01").alias("valid_to"),
    )
    second = named.select(
        "seller_id",
        F.concat(F.lit("R"), F.col("c_nationkey") + 1).alias("region"),
        F.lit("1998-01-01").alias("valid_from"),
        F.lit(None).cast("string").alias("valid_to"),
    )
    promo = base.filter(F.col("c_custkey") % 4 == 1).select(
        "seller_id",
        F.lit("PROMO").alias("region"),
        F.lit("1999-01-01").alias("valid_from"),
        F.lit("1999-07-01").alias("valid_to"),
    )

    def endless(name: str, share: int):
        """Starts with the promotion; closed, in the far future."""
        some = base.filter(F.col("c_custkey") % share == 1)
        return some.select("seller_id", *[F.lit(v).alias(c) for c, v in (("region", name), ("valid_from", "1999-01-01"), ("valid_to", "9999-12-31"))])

    every = first.unionByName(second).unionByName(promo).unionByName(endless("LATE", 12))
    # A NULL seller meets no order, not even one without a seller.
    nobody = every.limit(1).withColumn("seller_id", F.lit(None).cast("string"))
    return every.unionByName(endless("ALSO", 24)).unionByName(nobody)


def _seller_orders(t: Given):
    return t.orders.select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.when(F.col("o_orderkey") % 17 != 0, F.col("o_custkey")).cast("string").alias("seller_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date"),
        (F.col("o_orderkey") % 5 + 1).cast("int").alias("qty"),
        F.col("o_totalprice").alias("unit_price"),
        F.when(F.col("o_orderkey") % 10 == 0, "CANCELLED").otherwise(F.col("o_orderstatus")).alias("status"),
    )


def _refunds(t: Given):
    return t.lineitem.filter(F.col("l_returnflag") == "R").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("refund_id"),
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_quantity").alias("refund_amount"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("refund_date"),
    )


_REGION_TAIL = """
, live AS (
  SELECT o_orderkey, seller, strftime(o_orderdate, '%Y-%m-%d') AS order_date,
         (o_orderkey % 5 + 1) * CAST(o_totalprice AS DECIMAL(18, 2)) AS gross
  FROM sellers WHERE o_orderkey % 10 <> 0
), refunded AS (
  SELECT l_orderkey, sum(CAST(l_quantity AS DECIMAL(18, 2))) AS refund
  FROM lineitem WHERE l_returnflag = 'R' GROUP BY ALL
), placed AS (
  SELECT l.*, a.region FROM live l LEFT JOIN side a
    ON a.k = l.seller AND a.valid_from <= l.order_date AND (a.valid_to IS NULL OR l.order_date < a.valid_to)
  QUALIFY row_number() OVER (PARTITION BY l.o_orderkey ORDER BY a.valid_from DESC NULLS LAST, a.valid_to NULLS LAST, a.region) = 1
)
SELECT order_date, coalesce(region, 'UNKNOWN') AS region, count(DISTINCT o_orderkey) AS n_orders,
       CAST(sum(gross) AS DOUBLE) AS gross_gmv,
       CAST(coalesce(sum(refund), 0) AS DOUBLE) AS refund_amount,
       CAST(sum(gross) - coalesce(sum(refund), 0) AS DOUBLE) AS net_gmv
FROM placed LEFT JOIN refunded ON l_orderkey = o_orderkey
GROUP BY 1, 2
"""


@query(
    "effective_region_gmv",
    _ASSIGNED
    + """, side AS (
  SELECT k, region, valid_from,
         least(coalesce(valid_to, '99999'), coalesce(lead(valid_from) OVER (PARTITION BY k ORDER BY valid_from, valid_to DESC NULLS FIRST, region DESC), '99999'))
           AS valid_to
  FROM assigned
)"""
    + _REGION_TAIL,
)
def effective_region_gmv(t: Given):
    return serving.region_daily(_seller_orders(t), _assigned(t), _refunds(t))


@query("effective_region_rank", _ASSIGNED + ", side AS (SELECT * FROM assigned)" + _REGION_TAIL)
def effective_region_rank(t: Given):
    return serving.region_daily(_seller_orders(t), _assigned(t), _refunds(t), resolve="rank")


_PLACED = """
SELECT CAST(o_orderkey AS VARCHAR) AS order_id, coalesce(a.region, 'UNKNOWN') AS region
FROM sellers LEFT JOIN side a ON a.k = seller AND a.valid_from <= strftime(o_orderdate, '%Y-%m-%d')
  AND (a.valid_to IS NULL OR strftime(o_orderdate, '%Y-%m-%d') < a.valid_to)
QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY a.valid_from DESC NULLS LAST, a.valid_to NULLS LAST, a.region) = 1
"""


def _place(t: Given, resolve: str, direct: bool):
    """``direct`` also mixes ISO days of orders with timestamps of assignments."""
    dim = _assigned(t)
    if direct:
        dim = dim.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("valid_from", "valid_to")})
    placed = intervals.interval_join(
        _seller_orders(t),
        dim,
        ["seller_id"],
        "order_date",
        "valid_from",
        "valid_to",
        {"region": "UNKNOWN"},
        resolve=resolve,
        fact_key=["order_id"],
        direct=direct,
    )
    return placed.select("order_id", "region")


@query(
    "interval_merge_repair",
    _ASSIGNED
    + """, side AS (
  SELECT k, region, valid_from,
         least(coalesce(valid_to, '99999'), coalesce(lead(valid_from) OVER (PARTITION BY k ORDER BY valid_from, valid_to DESC NULLS FIRST, region DESC), '99999'))
           AS valid_to
  FROM assigned
)"""
    + _PLACED,
)
def interval_merge_repair(t: Given):
    return _place(t, "repair", direct=False)


@query("interval_merge_rank", _ASSIGNED + ", side AS (SELECT * FROM assigned)" + _PLACED)
def interval_merge_rank(t: Given):
    return _place(t, "rank", direct=False)


@query("interval_direct_repair", TWINS["interval_merge_repair"])
def interval_direct_repair(t: Given):
    return _place(t, "repair", direct=True)


@query("interval_direct_rank", TWINS["interval_merge_rank"])
def interval_direct_rank(t: Given):
    return _place(t, "rank", direct=True)


_DECADES = """
WITH spans AS (
  SELECT c_custkey AS k, 'N' || c_nationkey AS tier, DATE '1970-01-01' + CAST(c_custkey % 4000 AS INTEGER) AS lo,
         DATE '2000-01-01' + CAST(c_custkey % 3000 AS INTEGER) AS hi FROM customer
  UNION ALL
  SELECT c_custkey, c_mktsegment, DATE '1960-06-01' + CAST(7 * (c_custkey % 900) AS INTEGER),
         CASE WHEN c_custkey % 5 <> 0 THEN DATE '1996-01-01' + CAST(c_custkey % 700 AS INTEGER) END FROM customer
  UNION ALL
  SELECT o_custkey, o_orderpriority, CAST(o_orderdate AS DATE), CAST(o_orderdate AS DATE) + CAST(1 + o_orderkey % 400 AS INTEGER) FROM orders
)
SELECT o_orderkey, tier FROM orders LEFT JOIN spans ON k = o_custkey AND lo <= CAST(o_orderdate AS DATE) + CAST(o_orderkey % 90 AS INTEGER)
  AND (hi IS NULL OR CAST(o_orderdate AS DATE) + CAST(o_orderkey % 90 AS INTEGER) < hi)
QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY lo DESC NULLS LAST, hi NULLS LAST, tier) = 1
"""


@query("interval_decades_rank", _DECADES)
def interval_decades_rank(t: Given):
    """Closed intervals of thirty years under short ones that overlap, each order asking for some day after its own."""
    orders, customer = t.orders, t.customer
    day = F.col("o_orderdate").cast("date")
    shifted = lambda text, days: F.date_add(F.lit(text).cast("date"), days.cast("int"))
    key = F.col("c_custkey")
    parts = [
        customer.select(key.alias("k"), F.concat(F.lit("N"), "c_nationkey").alias("tier"), shifted("1970-01-01", key % 4000).alias("lo"), shifted("2000-01-01", key % 3000).alias("hi")),
        customer.select(key, "c_mktsegment", shifted("1960-06-01", 7 * (key % 900)), F.when(key % 5 != 0, shifted("1996-01-01", key % 700))),
        orders.select("o_custkey", "o_orderpriority", day, F.date_add(day, (1 + F.col("o_orderkey") % 400).cast("int"))),
    ]
    spans = parts[0].union(parts[1]).union(parts[2])
    asked = orders.select("o_orderkey", F.col("o_custkey").alias("k"), F.date_add(day, (F.col("o_orderkey") % 90).cast("int")).alias("at"))
    found = intervals.interval_join(asked, spans, ["k"], "at", "lo", "hi", {"tier": None}, resolve="rank", ties=["hi"])
    return found.select("o_orderkey", "tier")


@query("effective_region_direct", TWINS["effective_region_gmv"])
def effective_region_direct(t: Given):
    return serving.region_daily(_seller_orders(t), _assigned(t), _refunds(t), direct=True)


@query("effective_region_rank_direct", TWINS["effective_region_rank"])
def effective_region_rank_direct(t: Given):
    return serving.region_daily(_seller_orders(t), _assigned(t), _refunds(t), resolve="rank", direct=True)


@query(
    "interval_repair",
    _ASSIGNED
    + """
SELECT CAST(k AS VARCHAR) AS seller_id, region, valid_from,
       CASE WHEN least(coalesce(valid_to, '99999'), coalesce(nxt, '99999')) <> '99999'
            THEN least(coalesce(valid_to, '99999'), coalesce(nxt, '99999')) END AS valid_to
FROM (
  SELECT *, lead(valid_from) OVER (PARTITION BY k ORDER BY valid_from) AS nxt FROM assigned WHERE region NOT IN ('LATE', 'ALSO')
)
""",
)
def interval_repair(t: Given):
    some = _assigned(t).filter("seller_id IS NOT NULL AND region NOT IN ('LATE', 'ALSO')")
    return intervals.close_intervals(
        some, ["seller_id"], "valid_from", "valid_to", width=timedelta(days=365)
    )


@query(
    "rollup_then_join",
    """
SELECT o_orderkey, n_lines, quantity FROM orders LEFT JOIN (
  SELECT l_orderkey, count(*) AS n_lines, CAST(sum(CAST(l_quantity AS DECIMAL(18, 2))) AS DOUBLE) AS quantity
  FROM lineitem GROUP BY ALL
) ON l_orderkey = o_orderkey
""",
)
def rollup_then_join(t: Given):
    many = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_quantity")
    aggs = {"n_lines": F.count(F.lit(1)), "quantity": exact_sum("l_quantity")}
    return joins.rollup_then_join(t.orders.select("o_orderkey"), many, "o_orderkey", aggs)


# ---------------------------------------------------------------- telemetry

_WINDOWS = """
WITH closed AS (
  SELECT c_custkey AS k, TIMESTAMP '2024-01-10 00:00:00' AS lo, TIMESTAMP '2024-01-12 12:00:00' AS hi
  FROM customer WHERE c_custkey % 4 = 0
  UNION ALL
  SELECT c_custkey, TIMESTAMP '2024-01-11 06:00:00', TIMESTAMP '2024-01-13 00:00:00'
  FROM customer WHERE c_custkey % 8 = 0
)
"""


def _windows(t: Given, key: str = "device_id"):
    def window(every: int, lo: str, hi: str):
        return t.customer.filter(F.col("c_custkey") % every == 0).select(
            F.concat_ws("-", F.lit("T"), "c_custkey").alias("ticket_id"),
            F.col("c_custkey").alias(key),
            F.lit(lo).cast("timestamp_ntz").alias("window_start"),
            F.lit(hi).cast("timestamp_ntz").alias("window_end"),
        )

    return window(4, "2024-01-10 00:00:00", "2024-01-12 12:00:00").unionByName(
        window(8, "2024-01-11 06:00:00", "2024-01-13 00:00:00")
    )


@query(
    "interval_exclusion_hourly",
    _WINDOWS
    + """, raw AS (
  SELECT event_id, user_id, ts, value, ts AS ingest FROM events
  UNION ALL
  SELECT event_id + 1000000000, user_id, ts, value + (event_id % 20), ts + INTERVAL 2 MINUTE
  FROM events WHERE event_id % 10 = 0
), once AS (
  SELECT * FROM raw QUALIFY row_number() OVER (PARTITION BY user_id, ts ORDER BY ingest DESC, event_id DESC) = 1
), serving AS (
  SELECT o.*, 'SITE_' || c_nationkey AS site FROM once o JOIN customer ON c_custkey = user_id
  WHERE c_custkey % 7 <> 0 AND DATE '2023-12-01' <= CAST(ts AS DATE)
    AND (c_custkey % 5 <> 0 OR CAST(ts AS DATE) < DATE '2024-01-15')
)
SELECT CAST(user_id AS VARCHAR) AS device_id, strftime(ts, '%Y-%m-%d %H:00:00') AS reading_hour,
       site AS site_id, count(*) AS n_readings,
       CAST(sum(CAST(value AS DECIMAL(18, 6))) AS DOUBLE) / count(value) AS avg_temp_c,
       max(value) AS max_temp_c
FROM serving s
WHERE NOT EXISTS (SELECT 1 FROM closed w WHERE w.k = s.user_id AND w.lo <= s.ts AND s.ts < w.hi)
GROUP BY 1, 2, 3
""",
)
def interval_exclusion_hourly(t: Given):
    sent = t.events.select(
        "event_id",
        F.col("user_id").cast("string").alias("device_id"),
        F.col("ts").alias("reading_ts"),
        F.col("value").alias("temp_c"),
        F.col("ts").alias("ingest_ts"),
    )
    resent = sent.filter(F.col("event_id") % 10 == 0).select(
        (F.col("event_id") + 1_000_000_000).alias("event_id"),
        "device_id",
        "reading_ts",
        (F.col("temp_c") + F.col("event_id") % 20).alias("temp_c"),
        (F.col("ingest_ts") + F.expr("INTERVAL 2 MINUTES")).alias("ingest_ts"),
    )
    registry = t.customer.filter(F.col("c_custkey") % 7 != 0).select(
        F.col("c_custkey").cast("string").alias("device_id"),
        F.concat(F.lit("SITE_"), F.col("c_nationkey")).alias("site_id"),
        F.lit("2023-12-01").alias("installed_on"),
        F.when(F.col("c_custkey") % 5 == 0, "2024-01-15").alias("decommissioned_on"),
    )
    windows = _windows(t).withColumn("device_id", F.col("device_id").cast("string"))
    return facts.device_hours(sent.unionByName(resent), registry, windows)


@query(
    "interval_exclusion",
    _WINDOWS
    + """, every_window AS (
  SELECT * FROM closed
  UNION ALL
  SELECT c_custkey, TIMESTAMP '2024-01-25 00:00:00', NULL FROM customer WHERE c_custkey % 5 = 0
)
SELECT event_id, user_id, ts FROM events e
WHERE NOT EXISTS (SELECT 1 FROM every_window w
  WHERE w.k = e.user_id AND w.lo <= e.ts AND (w.hi IS NULL OR e.ts < w.hi))
""",
)
def interval_exclusion(t: Given):
    still_open = t.customer.filter(F.col("c_custkey") % 5 == 0).select(
        F.col("c_custkey").alias("user_id"),
        F.lit("2024-01-25").cast("timestamp_ntz").alias("window_start"),
        F.lit(None).cast("timestamp_ntz").alias("window_end"),
    )
    windows = _windows(t, "user_id").drop("ticket_id").unionByName(still_open)
    events = t.events.select("event_id", "user_id", "ts")
    return intervals.exclude_intervals(events, windows, ["user_id"], "ts", "window_start", "window_end")


# ---------------------------------------------------------------- campaigns and stores on local days

# One zone per remainder of the key by five.
ZONES = ("Asia/Tokyo", "America/Phoenix", "Asia/Kolkata", "Asia/Dubai", "UTC")

_ZONE = (
    "CASE {k} % 5 WHEN 0 THEN 'Asia/Tokyo' WHEN 1 THEN 'America/Phoenix' WHEN 2 THEN 'Asia/Kolkata' "
    "WHEN 3 THEN 'Asia/Dubai' ELSE 'UTC' END"
)


def _zone(key: Column):
    return F.element_at(F.array(*[F.lit(z) for z in ZONES]), (key % 5 + 1).cast("int"))


def _campaign_inputs(t: Given):
    events = t.events.select(
        "event_id",
        F.concat(F.lit("C"), F.col("user_id") % 7).alias("campaign_id"),
        F.concat(F.lit("P"), F.col("user_id") % 50).alias("placement_id"),
        F.when(F.col("event_type") == "click", "CLICK").otherwise("IMPRESSION").alias("event_type"),
        F.col("ts").alias("event_ts_utc"),
        F.col("value").alias("spend_usd"),
    )
    slots = materialise(
        t.events.select((F.col("user_id") % 50).alias("p"), (F.col("user_id") % 7).alias("c")).distinct()
    )
    placements = slots.select(
        F.concat(F.lit("P"), F.col("p")).alias("placement_id"),
        F.concat(F.lit("M"), F.col("p") % 5).alias("market_code"),
    ).distinct()
    markets = t.region.select(
        F.concat(F.lit("M"), F.col("r_regionkey")).alias("market_code"),
        _zone(F.col("r_regionkey")).alias("tz_name"),
        F.lit("USD").alias("reporting_currency"),
    )
    pairs = slots.select("c", (F.col("p") % 5).alias("m")).distinct().filter((F.col("c") + F.col("m")) % 6 != 0)
    flights = pairs.select(
        F.concat(F.lit("C"), F.col("c")).alias("campaign_id"),
        F.concat(F.lit("M"), F.col("m")).alias("market_code"),
        F.date_add(F.lit("2024-01-05").cast("date"), (F.col("c") % 3).cast("int"))
        .cast("string")
        .alias("flight_start_date"),
        F.date_add(F.lit("2024-01-20").cast("date"), F.col("m").cast("int"))
        .cast("string")
        .alias("flight_end_date"),
    )
    return events, placements, markets, flights


_CAMPAIGN = (
    """
WITH placed AS (
  SELECT user_id % 7 AS c, user_id % 50 % 5 AS m, event_type, value,
         CAST(timezone("""
    + _ZONE.format(k="(user_id % 50)")
    + """, timezone('UTC', ts)) AS DATE) AS day
  FROM events
)
SELECT 'C' || c AS campaign_id, 'M' || m AS market_code, CAST(day AS VARCHAR) AS local_date,
       count(*) FILTER (event_type <> 'click') AS n_impressions,
       count(*) FILTER (event_type = 'click') AS n_clicks,
       CAST(sum(CAST(value AS DECIMAL(18, 2))) AS DOUBLE) AS spend_usd
FROM placed
WHERE (c + m) % 6 <> 0
  AND day BETWEEN DATE '2024-01-05' + CAST(c % 3 AS INTEGER) AND DATE '2024-01-20' + CAST(m AS INTEGER)
GROUP BY 1, 2, 3
"""
)


@query("local_day_campaign", _CAMPAIGN)
def local_day_campaign(t: Given):
    return serving.campaign_daily(*_campaign_inputs(t))


@query("local_day_pushdown", _CAMPAIGN)
def local_day_pushdown(t: Given):
    return serving.campaign_daily(*_campaign_inputs(t), route="utc")


@query(
    "dense_local_report",
    """
WITH local_sales AS (
  SELECT user_id, value, CAST(timezone("""
    + _ZONE.format(k="user_id")
    + """, timezone('UTC', ts)) AS DATE) AS d FROM events WHERE event_type = 'purchase'
), daily AS (
  SELECT user_id, d, CAST(sum(CAST(value AS DECIMAL(18, 2))) AS DOUBLE) AS revenue, count(*) AS n
  FROM local_sales GROUP BY ALL
), axis AS (SELECT CAST(unnest(range(DATE '2024-01-10', DATE '2024-01-17', INTERVAL 1 DAY)) AS DATE) AS d)
SELECT c_custkey AS store_id, a.d AS d, coalesce(revenue, 0) AS revenue, coalesce(n, 0) AS n_txn
FROM customer CROSS JOIN axis a LEFT JOIN daily y ON y.user_id = c_custkey AND y.d = a.d
""",
)
def dense_local_report(t: Given):
    sales = t.events.filter(F.col("event_type") == "purchase").select(
        F.col("event_id").alias("txn_id"),
        F.col("user_id").alias("store_id"),
        F.col("ts").alias("ts_utc"),
        F.col("value").alias("amount"),
    )
    stores = t.customer.select(F.col("c_custkey").alias("store_id"), _zone(F.col("c_custkey")).alias("tz"))
    return serving.dense_store_report(sales, stores, date(2024, 1, 10), date(2024, 1, 16))


# ---------------------------------------------------------------- staging and payouts


@query(
    "staging_routed",
    """
WITH asked AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS request_id, 'N' || (o_custkey % 30) AS store_code,
         'SKU-' || o_custkey AS sku,
         CASE WHEN o_custkey % 4 <> 0 THEN 'CS' || (1 + o_orderkey % 2) END AS pack_code,
         o_custkey % 30 AS nk, o_custkey AS pk, 1 + o_orderkey % 9 AS qty, o_orderkey % 2 AS pick
  FROM orders
), judged AS (
  SELECT a.*, n_regionkey, p_size,
         CASE WHEN n_nationkey IS NULL THEN 'UNKNOWN_STORE' WHEN p_partkey IS NULL THEN 'UNKNOWN_SKU'
              WHEN p_partkey % 13 = 0 THEN 'DISCONTINUED_SKU' END AS reject_reason
  FROM asked a LEFT JOIN nation ON n_nationkey = nk
  LEFT JOIN (SELECT * FROM part WHERE p_partkey % 11 <> 0) ON p_partkey = pk
)
SELECT request_id, store_code, sku, pack_code,
       CASE WHEN reject_reason IS NULL THEN 'DC-' || n_regionkey END AS dc_code,
       CASE WHEN reject_reason IS NULL THEN
         CAST(qty * CASE WHEN pk % 4 = 0 THEN p_size WHEN pick = 0 THEN p_size ELSE 2 * p_size END AS INTEGER) END
         AS qty_units,
       CASE WHEN reject_reason IS NULL THEN 'ACCEPTED' ELSE 'QUARANTINED' END AS load_status,
       reject_reason
FROM judged
""",
)
def staging_routed(t: Given):
    store = F.concat(F.lit("N"), F.col("o_custkey") % 30)
    sku = F.concat(F.lit("SKU-"), F.col("o_custkey"))
    pack = F.concat(F.lit("cs"), F.col("o_orderkey") % 2 + 1)
    requests = t.orders.select(
        F.col("o_orderkey").cast("string").alias("request_id"),
        F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("  "), F.lower(store)))
        .otherwise(F.concat(store, F.lit(" ")))
        .alias("store_code"),
        F.when(F.col("o_orderkey") % 5 == 0, F.lower(sku)).otherwise(sku).alias("sku"),
        F.when(F.col("o_custkey") % 4 != 0, pack).alias("pack_code"),
        (F.col("o_orderkey") % 9 + 1).cast("int").alias("qty_cases"),
    )
    stores = t.nation.select(
        F.concat(F.lit("N"), F.col("n_nationkey")).alias("store_code"),
        F.concat(F.lit("DC-"), F.col("n_regionkey")).alias("dc_code"),
    )
    parts = t.part.select(F.concat(F.lit("SKU-"), F.col("p_partkey")).alias("sku"), "p_partkey", "p_size")
    skus = parts.filter(F.col("p_partkey") % 11 != 0).select(
        "sku", F.when(F.col("p_partkey") % 13 == 0, "DISCONTINUED").otherwise("ACTIVE").alias("sku_status")
    )
    single = F.array(F.struct(F.lit(None).cast("string").alias("pack_code"), F.col("p_size").alias("units")))
    double = F.array(
        F.struct(F.lit("CS1").alias("pack_code"), F.col("p_size").alias("units")),
        F.struct(F.lit("CS2").alias("pack_code"), (F.col("p_size") * 2).alias("units")),
    )
    packs = parts.select(
        "sku", F.explode(F.when(F.col("p_partkey") % 4 == 0, single).otherwise(double)).alias("pack")
    ).select("sku", "pack.pack_code", F.col("pack.units").alias("units_per_case"))
    return facts.staged_requests(requests, stores, skus, packs)


def trips(t: Given):
    return t.orders.select(
        F.col("o_orderkey").cast("string").alias("trip_id"),
        F.col("o_custkey").cast("string").alias("driver_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("completed_ts"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("fare_cents"),
        "o_orderkey",
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("first_seen_date"),
    )


def payout_dims(t: Given):
    drivers = t.customer.filter(F.col("c_custkey") % 6 != 0).select(
        F.col("c_custkey").cast("string").alias("driver_id"),
        F.when(F.col("c_custkey") % 5 != 0, F.concat(F.lit("F"), F.col("c_nationkey"))).alias("fleet_id"),
    )
    commissions = t.nation.filter(F.col("n_nationkey") % 4 != 0).select(
        F.concat(F.lit("F"), F.col("n_nationkey")).alias("fleet_id"),
        F.when(F.col("n_nationkey") % 7 != 0, F.col("n_nationkey") % 20 + 10).alias("commission_pct"),
    )
    return drivers, commissions


PAYOUTS = """
WITH priced AS (
  SELECT o_orderkey, o_custkey, o_orderdate, CAST(round(o_totalprice * 100) AS BIGINT) AS fare,
         CASE WHEN c_custkey % 5 <> 0 THEN 'F' || c_nationkey END AS fleet, pct
  FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 6 <> 0) ON c_custkey = o_custkey
  LEFT JOIN (
    SELECT n_nationkey, CASE WHEN n_nationkey % 7 <> 0 THEN n_nationkey % 20 + 10 END AS pct
    FROM nation WHERE n_nationkey % 4 <> 0
  ) ON n_nationkey = c_nationkey AND c_custkey % 5 <> 0
)
SELECT CAST(o_orderkey AS VARCHAR) AS trip_id, CAST(o_custkey AS VARCHAR) AS driver_id, fleet AS fleet_id,
       strftime(o_orderdate, '%Y-%m-%d') AS trip_date, fare AS fare_cents,
       CASE WHEN pct IS NOT NULL THEN fare - (fare * pct) // 100 END AS driver_earning_cents,
       {first_seen} AS first_seen_date,
       CASE WHEN pct IS NOT NULL THEN 'PUBLISHED' ELSE 'PENDING' END AS load_status
FROM priced
"""


@query(
    "payout_resolution",
    PAYOUTS.format(
        first_seen="CASE WHEN o_orderkey % 5 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') ELSE '2001-08-02' END"
    ),
)
def payout_resolution(t: Given):
    every = trips(t)
    carried = F.col("o_orderkey") % 5 == 0
    landed = every.filter(~carried).withColumn("landing_date", F.lit("2001-08-02"))
    return facts.trip_payouts(landed, every.filter(carried), *payout_dims(t))


@query(
    "complement_split",
    """
SELECT o_orderkey, o_custkey, CASE WHEN EXISTS (
  SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R') THEN 'PUBLISHED' ELSE 'PENDING' END
  AS load_status FROM orders
""",
)
def complement_split(t: Given):
    orders = t.orders.select("o_orderkey", "o_custkey")
    returned = t.lineitem.filter(F.col("l_returnflag") == "R").select(F.col("l_orderkey").alias("o_orderkey"))
    published = joins.keep_if_exists(orders, returned, "o_orderkey")
    return joins.split_complement(orders, published, "o_orderkey", "load_status")
