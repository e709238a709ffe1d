"""Arrays, maps, structs, payloads and dirty text, derived row by row from the given tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import parsing, payload
from ..functions.timing import whole_div
from ..functions.values import bucketize
from ..operators import nested
from ..operators.rowwise import in_range, normalise_keys, zero_fill
from ..plans import reports
from ..sources.tables import sql
from .registry import Given, query


def _upto(n: Column, most: int) -> Column:
    """The array 1..n for n from 0 to ``most``."""
    return F.filter(F.array(*[F.lit(i) for i in range(1, most + 1)]), lambda i: i <= n)


def _baskets(t: Given):
    key = F.col("o_orderkey")
    items = F.transform(_upto(key % 6, 5), lambda i: F.concat(F.lit("item"), (key * i) % 17))
    return t.orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer"),
        F.when(key % 29 != 0, items).alias("items"),
    )


_BASKETS = """
WITH baskets AS (
  SELECT o_custkey AS customer, o_orderkey, CASE WHEN o_orderkey % 29 <> 0 THEN
    list_transform(range(1, CAST(o_orderkey % 6 AS BIGINT) + 1), lambda i: 'item' || ((o_orderkey * i) % 17)) END AS items
  FROM orders
), rows AS (SELECT customer, unnest(items) AS item FROM baskets)
SELECT b.customer, coalesce(s.items, '') AS distinct_items, coalesce(s.n, 0) AS total_items
FROM (SELECT DISTINCT customer FROM baskets) b LEFT JOIN (
  SELECT customer, array_to_string(list_sort(list(DISTINCT item)), '|') AS items, count(*) AS n
  FROM rows GROUP BY ALL
) s ON s.customer = b.customer
"""


def _joined(df):
    return df.withColumn("distinct_items", F.array_join("distinct_items", "|"))


@query("array_summary", _BASKETS)
def array_summary(t: Given):
    return _joined(nested.array_summary(_baskets(t), ["customer"], "items"))


@query("array_summary_flatten", _BASKETS)
def array_summary_flatten(t: Given):
    return _joined(nested.array_summary(_baskets(t), ["customer"], "items", route="flatten", row_id="order_id"))


def _bags(t: Given):
    key = F.col("event_id")
    device = F.element_at(F.array(F.lit("mobile"), F.lit("desktop"), F.lit("tablet")), (key % 3 + 1).cast("int"))
    entries = F.array(
        F.struct(F.lit("device").alias("k"), device.alias("v")),
        F.struct(F.lit("channel").alias("k"), F.when(key % 5 == 0, F.lit("mobile")).alias("v")),
        F.struct(F.lit("os").alias("k"), F.when(key % 2 == 0, F.lit("linux")).alias("v")),
    )
    bag = F.map_from_entries(F.filter(entries, lambda e: e["v"].isNotNull()))
    nothing = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    return t.events.select(
        "event_id",
        "user_id",
        F.when(key % 7 == 0, F.lit(None)).when(key % 11 == 0, nothing).otherwise(bag).alias("props"),
    )


_BAGS = """
WITH bags AS (
  SELECT event_id, user_id, event_id % 7 <> 0 AND event_id % 11 <> 0 AS filled,
         ['mobile', 'desktop', 'tablet'][CAST(event_id % 3 + 1 AS INTEGER)] AS device FROM events
)
"""


@query(
    "map_report",
    _BAGS
    + """
SELECT user_id, count(*) AS total_events, count(*) FILTER (filled AND device = 'mobile') AS mobile_events,
       CAST(bool_or(filled) AS BIGINT) + CAST(bool_or(filled AND event_id % 5 = 0) AS BIGINT)
         + CAST(bool_or(filled AND event_id % 2 = 0) AS BIGINT) AS distinct_keys
FROM bags GROUP BY ALL
""",
)
def map_report(t: Given):
    return nested.map_report(_bags(t), ["user_id"], "props", "device", "mobile")


@query(
    "map_rows",
    _BAGS
    + """
SELECT event_id, 'device' AS key, device AS value FROM bags WHERE filled
UNION ALL SELECT event_id, 'channel', 'mobile' FROM bags WHERE filled AND event_id % 5 = 0
UNION ALL SELECT event_id, 'os', 'linux' FROM bags WHERE filled AND event_id % 2 = 0
UNION ALL SELECT event_id, NULL, NULL FROM bags WHERE NOT filled
""",
)
def map_rows(t: Given):
    return nested.map_rows(_bags(t), ["event_id"], "props")


@query(
    "struct_profile",
    """
WITH seen AS (
  SELECT user_id, CASE WHEN event_id % 8 <> 0 AND event_id % 5 <> 0 THEN
    ['iOS', 'Android', 'Windows', 'Linux'][CAST(event_id // 3 % 4 + 1 AS INTEGER)] END AS os FROM events
), ranked AS (
  SELECT user_id, os FROM seen WHERE os IS NOT NULL GROUP BY user_id, os
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, os) = 1
)
SELECT s.user_id, count(*) AS total_events, count(*) FILTER (s.os IN ('iOS', 'Android')) AS mobile_events,
       count(DISTINCT s.os) AS distinct_os, coalesce(any_value(r.os), 'UNKNOWN') AS primary_os
FROM seen s LEFT JOIN ranked r ON r.user_id = s.user_id GROUP BY s.user_id
""",
)
def struct_profile(t: Given):
    key = F.col("event_id")
    names = F.array(*[F.lit(n) for n in ("iOS", "Android", "Windows", "Linux")])
    os = F.when(key % 5 != 0, F.element_at(names, (whole_div(key, F.lit(3)) % 4 + 1).cast("int")))
    device = F.when(key % 8 != 0, F.struct(os.alias("os"), F.lit("1").alias("version")))
    events = t.events.select("user_id", "event_type", device.alias("device"))
    return nested.struct_profile(events, ["user_id"], "device.os", ["iOS", "Android"])


def _lines(t: Given):
    key = F.col("o_orderkey")
    lines = F.transform(
        _upto(key % 6, 5),
        lambda i: F.struct(
            F.concat(F.lit("sku"), i).alias("sku"),
            ((key * i) % 15).cast("int").alias("qty"),
            ((key * i) % 997 / F.lit(100.0)).alias("unit_price"),
            F.when((key + i) % 4 == 0, "CANCELLED").otherwise("ACTIVE").alias("status"),
            ((key + i) % 7 != 0).alias("in_stock"),
        ),
    )
    return t.orders.select(F.col("o_orderkey").alias("order_id"), F.when(key % 29 != 0, lines).alias("items"))


_LINES = """
WITH lines AS (
  SELECT o_orderkey AS k, unnest(range(1, CAST(o_orderkey % 6 AS BIGINT) + 1)) AS i FROM orders
  WHERE o_orderkey % 29 <> 0
), live AS (
  SELECT k, (k * i) % 15 AS qty, (k * i) % 997 AS cents, (k + i) % 7 <> 0 AS in_stock FROM lines WHERE (k + i) % 4 <> 0
), summed AS (
  SELECT k, count(*) AS n, CAST(sum(qty * cents) AS BIGINT) AS total, bool_or(qty >= 10) AS bulk, bool_and(in_stock) AS stock
  FROM live GROUP BY ALL
)
SELECT o_orderkey AS order_id, CAST(coalesce(n, 0) AS INTEGER) AS n_active, coalesce(total, 0) / 100.0 AS active_total,
       coalesce(bulk, false) AS has_bulk, coalesce(stock, false) AS all_in_stock
FROM orders LEFT JOIN summed ON k = o_orderkey
"""


@query("line_summary", _LINES)
def line_summary(t: Given):
    return nested.line_summary(_lines(t), ["order_id"], "items")


@query("line_summary_exploded", _LINES)
def line_summary_exploded(t: Given):
    return nested.line_summary_exploded(_lines(t), ["order_id"], "items")


@query(
    "flatten_items",
    """
WITH rows AS (
  SELECT event_id, user_id, i, CAST((event_id * i) % 7 - 1 AS INTEGER) AS quantity
  FROM events, LATERAL (SELECT unnest(range(1, CAST(event_id % 4 AS BIGINT) + 1)) AS i)
)
SELECT event_id, 'C' || (user_id % 9) AS country, event_type AS device, 'item' || i AS item_id, quantity
FROM rows JOIN events USING (event_id, user_id) WHERE quantity >= 0
UNION ALL
SELECT event_id, 'C' || (user_id % 9), event_type, NULL, NULL FROM events WHERE event_id % 4 = 0
""",
)
def flatten_items(t: Given):
    key = F.col("event_id")
    items = F.transform(
        _upto(key % 4, 3),
        lambda i: F.struct(
            F.concat(F.lit("item"), i).alias("item_id"), ((key * i) % 7 - 1).cast("int").alias("quantity")
        ),
    )
    events = t.events.select(
        "event_id",
        F.struct(
            F.concat(F.lit("C"), F.col("user_id") % 9).alias("country"), F.col("event_type").alias("device")
        ).alias("meta"),
        items.alias("items"),
    )
    return nested.flatten_items(events, ["event_id"], "meta", ["country", "device"], "items", "quantity")


def _requests(t: Given):
    key = F.col("event_id")
    text = (
        F.when(key % 7 == 0, F.lit(None))
        .when(key % 11 == 0, F.lit(""))
        .when(key % 5 == 0, F.lit("tier="))
        .when(key % 3 == 0, F.lit("region=us&lang=en&x=1"))
        .otherwise(F.concat(F.lit("tier="), "event_type", F.lit("&k="), key % 9))
    )
    return t.events.select(
        F.col("event_id").alias("req_id"), text.alias("payload"), (F.col("value") * 10).cast("int").alias("latency_ms")
    )


_REQUESTS = """
SELECT event_id AS req_id,
       CAST(CASE WHEN event_id % 7 = 0 OR event_id % 11 = 0 THEN 0 WHEN event_id % 5 = 0 THEN 1
            WHEN event_id % 3 = 0 THEN 3 ELSE 2 END AS INTEGER) AS n_params,
       CASE WHEN event_id % 7 = 0 OR event_id % 11 = 0 THEN 'UNKNOWN' WHEN event_id % 5 = 0 THEN ''
            WHEN event_id % 3 = 0 THEN 'UNKNOWN' ELSE upper(event_type) END AS user_tier,
       CASE WHEN trunc(value * 10) < 100 THEN 'FAST' WHEN trunc(value * 10) < 500 THEN 'NORMAL' ELSE 'SLOW' END
         AS latency_bucket
FROM events
"""


def _bucket():
    return bucketize("latency_ms", [100, 500], ["FAST", "NORMAL", "SLOW"]).alias("latency_bucket")


@query("payload_parse", _REQUESTS)
def payload_parse(t: Given):
    return _requests(t).select(
        "req_id",
        payload.n_params("payload").alias("n_params"),
        payload.param("payload", "tier").alias("user_tier"),
        _bucket(),
    )


@query("payload_udf", _REQUESTS)
def payload_udf(t: Given):
    count, tier, _ = payload.payload_udfs()
    return _requests(t).select(
        "req_id", count("payload").alias("n_params"), tier("payload").alias("user_tier"), _bucket()
    )


@query("payload_udf_struct", _REQUESTS)
def payload_udf_struct(t: Given):
    _, _, both = payload.payload_udfs()
    parsed = _requests(t).withColumn("_p", both("payload"))
    return parsed.select("req_id", "_p.n_params", "_p.user_tier", _bucket())


@query("payload_udf_sql", _REQUESTS)
def payload_udf_sql(t: Given):
    payload.register_payload_udfs(t.spark)
    return sql(
        t.spark,
        """
        SELECT req_id, payload_count(payload) AS n_params, payload_tier(payload) AS user_tier,
               CASE WHEN latency_ms < 100 THEN 'FAST' WHEN latency_ms < 500 THEN 'NORMAL' ELSE 'SLOW' END AS latency_bucket
        FROM {requests}
        """,
        requests=_requests(t),
    )


# ---------------------------------------------------------------- dirty text


def _two(n: Column, width: int = 2) -> Column:
    return F.lpad(n.cast("string"), width, "0")


def _raw(t: Given):
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    dollars = whole_div(cents, F.lit(100))
    plain = F.concat(dollars, F.lit("."), _two(cents % 100))
    comma = F.concat(
        F.lit("$"), whole_div(dollars, F.lit(1000)), F.lit(","), _two(dollars % 1000, 3), F.lit("."), _two(cents % 100)
    )
    kind = (F.col("l_orderkey") + F.col("l_linenumber")) % 10
    amount = (
        F.when(kind == 0, F.lit(None))
        .when(kind == 1, "N/A")
        .when(kind == 2, comma)
        .when(kind == 3, F.concat(F.lit("  -$"), plain, F.lit(" ")))
        .when(kind == 4, "   ")
        .when(kind == 5, "NaN")
        .when(kind == 6, "1e3")
        .otherwise(plain)
    )
    count = F.col("l_quantity").cast("int")
    units = (
        F.when(kind == 1, F.lit(None))
        .when(kind == 2, F.concat(count, F.lit(".0")))
        .when(kind == 3, F.concat(count, F.lit(".5")))
        .when(kind == 4, "many")
        .when(kind == 5, "3000000000")
        .when(kind == 6, F.concat(F.lit(" "), count, F.lit(" ")))
        .otherwise(count.cast("string"))
    )
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        F.concat_ws("-", "l_returnflag", "l_suppkey").alias("source"),
        amount.alias("amount_raw"),
        units.alias("units_raw"),
    )


# The twin knows each row's true amount and units: the text is written from them by remainder.
_RAW = """
WITH raw AS (
  SELECT l_orderkey, l_linenumber, l_returnflag || '-' || l_suppkey AS source,
         (l_orderkey + l_linenumber) % 10 AS kind, CAST(round(l_extendedprice * 100) AS BIGINT) AS c,
         CAST(l_quantity AS INTEGER) AS q
  FROM lineitem
), parsed AS (
  SELECT *, CASE WHEN kind IN (0, 1, 4, 5, 6) THEN NULL WHEN kind = 3 THEN -c ELSE c END AS cents,
         CASE WHEN kind IN (1, 3, 4, 5) THEN NULL ELSE q END AS units
  FROM raw
)
"""

_INGESTION = (
    _RAW
    + """, summed AS (
  SELECT source, count(*) AS n_records, count(*) FILTER (cents IS NULL) AS n_bad_amount,
         CAST(sum(cents) AS BIGINT) AS net, CAST(coalesce(sum(units), 0) AS BIGINT) AS total_units
  FROM parsed GROUP BY ALL
)
SELECT source, n_records, n_bad_amount, net / 100.0 AS net_amount, total_units,
       CASE WHEN total_units <> 0 THEN CASE WHEN net >= 0 THEN (2 * net + total_units) // (2 * total_units)
         ELSE -((-2 * net + total_units) // (2 * total_units)) END / 100.0 END AS avg_unit_price
FROM summed
"""
)


@query("ingestion_report", _INGESTION)
def ingestion_report(t: Given):
    return reports.ingestion_report(_raw(t))


@query("ingestion_report_mask", _INGESTION)
def ingestion_report_mask(t: Given):
    return reports.ingestion_report(_raw(t), money_route="mask")


@query(
    "parse_money_cast",
    _RAW
    + """
SELECT l_orderkey, l_linenumber, CASE WHEN kind = 6 THEN 1000.0 WHEN kind <> 5 THEN cents / 100.0 END AS amount,
       kind = 5 AS is_nan FROM parsed
""",
)
def parse_money_cast(t: Given):
    """The cast route takes NaN for a number, the others do not."""
    parsed = _raw(t).withColumn("amount", parsing.parse_money("amount_raw"))
    known = F.when(~F.isnan("amount"), F.col("amount"))
    return parsed.select("l_orderkey", "l_linenumber", known.alias("amount"), F.coalesce(F.isnan("amount"), F.lit(False)).alias("is_nan"))


_AMOUNTS = _RAW + "SELECT l_orderkey, l_linenumber, cents / 100.0 AS amount FROM parsed"


@query("parse_money_regex", _AMOUNTS)
def parse_money_regex(t: Given):
    amount = parsing.parse_money("amount_raw", "regex")
    return _raw(t).select("l_orderkey", "l_linenumber", amount.alias("amount"))


@query("parse_money_mask", _AMOUNTS)
def parse_money_mask(t: Given):
    amount = parsing.parse_money("amount_raw", "mask")
    return _raw(t).select("l_orderkey", "l_linenumber", amount.alias("amount"))


@query(
    "parse_money_wide",
    """
SELECT l_orderkey, l_linenumber, CAST(l_orderkey || '0000000000000000.125' AS DOUBLE) AS whole,
       CAST('0.' || l_linenumber || '00000000001' AS DOUBLE) AS fine FROM lineitem
""",
)
def parse_money_wide(t: Given):
    """More digits than a mask for money would have, before and behind the point."""
    texts = t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        F.concat(F.lit("$"), "l_orderkey", F.lit("0000000000000000.125")).alias("whole"),
        F.concat(F.lit("0."), "l_linenumber", F.lit("00000000001")).alias("fine"),
    )
    return texts.withColumns({c: parsing.parse_money(c, "mask") for c in ("whole", "fine")})


@query("parse_count", _RAW + "SELECT l_orderkey, l_linenumber, units FROM parsed")
def parse_count(t: Given):
    return _raw(t).select("l_orderkey", "l_linenumber", parsing.parse_count("units_raw").alias("units"))


@query(
    "tidy_and_filter",
    """
SELECT event_id, upper(event_type) AS event_type, value, coalesce(CASE WHEN event_id % 4 <> 0 THEN user_id END, 0) AS user_id
FROM events WHERE value BETWEEN 5 AND 120
""",
)
def tidy_and_filter(t: Given):
    padded = t.events.select(
        "event_id",
        F.concat(F.lit("  "), "event_type", F.lit(" ")).alias("event_type"),
        "value",
        F.when(F.col("event_id") % 4 != 0, F.col("user_id")).alias("user_id"),
    )
    return zero_fill(normalise_keys(in_range(padded, "value", 5.0, 120.0), ["event_type"]), {"user_id": 0})
