"""Joins, skew handling and the reports built on them."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.values import any_of
from ..operators import joins, skew
from ..operators.rowwise import project
from ..plans import reports, serving
from ..sources.tables import sql
from .registry import Given, query


def _fill(c: str, every: int, key: str):
    """The column, NULL where the key is a multiple of ``every``."""
    return F.when(F.col(key) % every != 0, F.col(c))


@query(
    "inner_join",
    """
SELECT c_mktsegment, o_orderpriority, count(*) AS n_orders
FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY ALL
""",
)
def inner_join(t: Given):
    orders = project(t.orders, {"c_custkey": "o_custkey", "o_orderpriority": "o_orderpriority"})
    joined = orders.join(t.customer.select("c_custkey", "c_mktsegment"), "c_custkey")
    return joined.groupBy("c_mktsegment", "o_orderpriority").agg(F.count(F.lit(1)).alias("n_orders"))


@query(
    "enrich_default",
    """
SELECT o_orderkey, coalesce(c_mktsegment, 'UNKNOWN') AS c_mktsegment, coalesce(c_nationkey, -1) AS c_nationkey
FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 5 <> 0) ON c_custkey = o_custkey
""",
)
def enrich_default(t: Given):
    dim = t.customer.filter(F.col("c_custkey") % 5 != 0).withColumnRenamed("c_custkey", "o_custkey")
    facts = t.orders.select("o_orderkey", "o_custkey")
    return joins.enrich(facts, dim, "o_custkey", {"c_mktsegment": "UNKNOWN", "c_nationkey": -1}).drop("o_custkey")


@query(
    "region_revenue",
    """
SELECT coalesce(n_name, 'UNKNOWN') AS region, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS revenue
FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 5 <> 0) ON c_custkey = o_custkey
LEFT JOIN nation ON n_nationkey = c_nationkey
GROUP BY 1
""",
)
def region_revenue(t: Given):
    stores = (
        t.customer.filter(F.col("c_custkey") % 5 != 0)
        .join(t.nation.withColumnRenamed("n_nationkey", "c_nationkey"), "c_nationkey")
        .select(F.col("c_custkey").alias("store_id"), F.col("n_name").alias("region"))
    )
    sales = t.orders.select(
        F.col("o_custkey").alias("store_id"), F.round(F.col("o_totalprice") * 100).cast("bigint").alias("amount")
    )
    return reports.region_revenue(sales, stores)


@query(
    "broadcast_report",
    """
SELECT n_name, count(*) AS n_customers FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY ALL
""",
)
def broadcast_report(t: Given):
    small = joins.broadcast_within(t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name"))
    return (
        t.customer.join(small, "c_nationkey").groupBy("n_name").agg(F.count(F.lit(1)).alias("n_customers"))
    )


_NATIONS = """
SELECT n_name, count(*) AS n_customers, CAST(sum(CAST(c_acctbal AS DECIMAL(18, 2))) AS DOUBLE) AS balance
FROM customer JOIN nation ON n_nationkey = c_nationkey
WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')
  AND NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '2-HIGH' AND o_orderstatus = 'P')
GROUP BY ALL
"""


@query("existence_sql", _NATIONS)
def existence_sql(t: Given):
    return sql(
        t.spark,
        f"""
        SELECT {joins.broadcast_hint(t.nation, 'n')} n.n_name, count(*) AS n_customers,
               CAST(sum(CAST(c.c_acctbal AS DECIMAL(18, 2))) AS DOUBLE) AS balance
        FROM {{customer}} c JOIN {{nation}} n ON n.n_nationkey = c.c_nationkey
        WHERE c.c_custkey IN (SELECT o_custkey FROM {{orders}} WHERE o_orderstatus = 'F')
          AND NOT EXISTS (SELECT 1 FROM {{orders}} o WHERE o.o_custkey = c.c_custkey AND o.o_orderpriority = '2-HIGH' AND o.o_orderstatus = 'P')
        GROUP BY n.n_name
        """,
        customer=t.customer,
        nation=t.nation,
        orders=t.orders,
    )


@query("existence_joins_sql", _NATIONS)
def existence_joins_sql(t: Given):
    return sql(
        t.spark,
        """
        SELECT n_name, count(*) AS n_customers, CAST(sum(CAST(c_acctbal AS DECIMAL(18, 2))) AS DOUBLE) AS balance
        FROM {customer} JOIN {nation} ON n_nationkey = c_nationkey
        LEFT SEMI JOIN (SELECT o_custkey FROM {orders} WHERE o_orderstatus = 'F') f ON f.o_custkey = c_custkey
        LEFT ANTI JOIN (SELECT o_custkey FROM {orders} WHERE o_orderpriority = '2-HIGH' AND o_orderstatus = 'P') x ON x.o_custkey = c_custkey
        GROUP BY n_name
        """,
        customer=t.customer,
        nation=t.nation,
        orders=t.orders,
    )


@query(
    "outreach_list",
    """
SELECT c_custkey AS cust_id, 'N' || c_nationkey AS country FROM customer
WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)
  AND NOT EXISTS (SELECT 1 FROM events WHERE event_type = 'error' AND event_id % 3 <> 0 AND user_id = c_custkey)
""",
)
def outreach_list(t: Given):
    customers = t.customer.select(
        F.col("c_custkey").alias("cust_id"), F.concat(F.lit("N"), F.col("c_nationkey")).alias("country")
    )
    orders = t.orders.select(F.col("o_custkey").alias("cust_id"))
    complaints = t.events.filter(F.col("event_type") == "error").select(
        F.col("event_id").alias("complaint_id"), _fill("user_id", 3, "event_id").alias("cust_id")
    )
    return serving.outreach_list(customers, orders, complaints)


@query(
    "exists_filter",
    """
SELECT o_orderkey, o_custkey FROM orders
WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity >= 45)
""",
)
def exists_filter(t: Given):
    big = t.lineitem.filter(F.col("l_quantity") >= 45).select(F.col("l_orderkey").alias("o_orderkey"))
    return joins.keep_if_exists(t.orders.select("o_orderkey", "o_custkey"), big, "o_orderkey")


@query(
    "not_exists_filter",
    """
SELECT o_orderkey, o_custkey FROM orders
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_orderkey % 3 <> 0)
""",
)
def not_exists_filter(t: Given):
    lines = t.lineitem.select(_fill("l_orderkey", 3, "l_orderkey").alias("o_orderkey"))
    return joins.drop_if_exists(t.orders.select("o_orderkey", "o_custkey"), lines, "o_orderkey")


@query(
    "not_in_list",
    """
SELECT o_orderkey, o_custkey FROM orders
WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity >= 40)
""",
)
def not_in_list(t: Given):
    listed = t.lineitem.filter(F.col("l_quantity") >= 40)
    return joins.not_in_by_counts(t.orders.select("o_orderkey", "o_custkey"), listed, "o_orderkey", "l_orderkey")


@query(
    "not_in_null",
    """
SELECT o_orderkey, o_custkey FROM orders
WHERE o_orderkey NOT IN (SELECT CASE WHEN l_linenumber <> 7 THEN l_orderkey END FROM lineitem)
""",
)
def not_in_null(t: Given):
    listed = t.lineitem.select(F.when(F.col("l_linenumber") != 7, F.col("l_orderkey")).alias("l_orderkey"))
    return joins.not_in_by_counts(t.orders.select("o_orderkey", "o_custkey"), listed, "o_orderkey", "l_orderkey")


_VARIANTS = """
WITH catalog AS (
  SELECT p_brand AS sku, CASE WHEN p_size % 4 <> 0 THEN p_type END AS variant, count(*) AS n_parts
  FROM part GROUP BY ALL
), offers AS (
  SELECT p_brand AS sku, CASE WHEN p_size % 4 <> 0 THEN p_type END AS variant,
         CAST(l_suppkey AS VARCHAR) AS seller, CASE WHEN l_orderkey % 7 <> 0 THEN l_extendedprice END AS price
  FROM lineitem JOIN part ON p_partkey = l_partkey WHERE p_type <> 'PROMO' OR p_size % 4 = 0
)
"""


def _catalog(t: Given):
    return (
        t.part.select(F.col("p_brand").alias("sku"), _fill("p_type", 4, "p_size").alias("variant"))
        .groupBy("sku", "variant")
        .agg(F.count(F.lit(1)).alias("n_parts"))
    )


def _offers(t: Given):
    parts = t.part.select(
        F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("sku"), _fill("p_type", 4, "p_size").alias("variant")
    )
    lines = t.lineitem.select(
        "l_partkey", F.col("l_suppkey").cast("string").alias("seller"), _fill("l_extendedprice", 7, "l_orderkey").alias("price")
    )
    offered = F.col("variant").isNull() | ~any_of("variant", ["PROMO"])
    return lines.join(parts, "l_partkey").filter(offered).select("sku", "variant", "seller", "price")


_TOTALS = """
, totals AS (SELECT sku, variant, count(*) AS n_offers FROM offers GROUP BY ALL)
SELECT c.sku, c.variant, n_parts, n_offers FROM catalog c
LEFT JOIN totals t ON t.sku = c.sku AND t.variant IS NOT DISTINCT FROM c.variant
"""


def _offer_totals(t: Given):
    return _offers(t).groupBy("sku", "variant").agg(F.count(F.lit(1)).alias("n_offers"))


@query("null_safe_join", _VARIANTS + _TOTALS)
def null_safe_join(t: Given):
    return joins.null_safe_join(_catalog(t), _offer_totals(t), ["sku", "variant"], ["variant"])


@query("sentinel_join", _VARIANTS + _TOTALS)
def sentinel_join(t: Given):
    return joins.sentinel_join(_catalog(t), _offer_totals(t), ["sku", "variant"], "variant", "(none)")


@query(
    "best_offers",
    _VARIANTS
    + """, best AS (
  SELECT * FROM offers WHERE price IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY sku, variant ORDER BY price, seller) = 1
)
, totals AS (SELECT sku, variant, count(*) AS n_offers FROM offers GROUP BY ALL)
SELECT c.sku, coalesce(c.variant, 'BASE') AS variant_label, CAST(n_parts AS VARCHAR) AS product_name,
       coalesce(n_offers, 0) AS n_offers, coalesce(b.seller, 'NONE') AS best_seller, b.price AS best_price
FROM catalog c
LEFT JOIN totals t ON t.sku = c.sku AND t.variant IS NOT DISTINCT FROM c.variant
LEFT JOIN best b ON b.sku = c.sku AND b.variant IS NOT DISTINCT FROM c.variant
""",
)
def best_offers(t: Given):
    catalog = _catalog(t).withColumn("product_name", F.col("n_parts").cast("string"))
    return reports.best_offers(catalog, _offers(t))


@query(
    "lookup_chain",
    """
SELECT l_orderkey, l_linenumber, l_partkey, o_custkey, c_nationkey FROM lineitem
LEFT JOIN (SELECT * FROM orders WHERE o_orderkey % 6 <> 0) ON o_orderkey = l_orderkey
LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 5 <> 0) ON c_custkey = o_custkey
""",
)
def lookup_chain(t: Given):
    orders = t.orders.filter(F.col("o_orderkey") % 6 != 0).withColumnRenamed("o_orderkey", "l_orderkey")
    customers = t.customer.filter(F.col("c_custkey") % 5 != 0).withColumnRenamed("c_custkey", "o_custkey")
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    return joins.lookup_chain(
        lines, [(orders, "l_orderkey", ["o_custkey"]), (customers, "o_custkey", ["c_nationkey"])]
    )


@query(
    "fan_out_probe",
    """
SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY ALL HAVING count(*) > 1
""",
)
def fan_out_probe(t: Given):
    return joins.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    "date_spine",
    """
SELECT DISTINCT c_mktsegment, CAST(d AS DATE) AS d FROM customer,
  (SELECT unnest(range(DATE '2024-02-26', DATE '2024-03-04', INTERVAL 1 DAY)) AS d)
""",
)
def date_spine(t: Given):
    return joins.spine(t.customer.select("c_mktsegment").distinct(), "2024-02-26", "2024-03-03")


# A third of all orders folded onto one customer.
_FOLDED = "CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE o_custkey END"


def _skewed(t: Given):
    return t.orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.when(F.col("o_orderkey") % 3 == 0, F.lit(0)).otherwise(F.col("o_custkey")).cast("string").alias("customer_id"),
        F.col("o_orderpriority").alias("product"),
        F.col("o_totalprice").alias("amount"),
    )


def _segments(t: Given):
    return t.customer.select(
        F.col("c_custkey").cast("string").alias("customer_id"), F.col("c_mktsegment").alias("segment")
    )


_SUMMARY = f"""
SELECT CAST({_FOLDED} AS VARCHAR) AS customer_id, c_mktsegment AS segment,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS total_amount,
       count(DISTINCT o_orderpriority) AS n_products
FROM orders JOIN customer ON c_custkey = {_FOLDED} GROUP BY 1, 2
"""


@query("salted_summary_key", _SUMMARY)
def salted_summary_key(t: Given):
    return reports.salted_customer_summary(_skewed(t), _segments(t), n=3)


@query("salted_summary_set", _SUMMARY)
def salted_summary_set(t: Given):
    return reports.salted_customer_summary(_skewed(t), _segments(t), n=3, route="set")


@query("salted_summary_hot", _SUMMARY)
def salted_summary_hot(t: Given):
    orders = _skewed(t)
    hot = skew.hot_keys(orders, "customer_id", share=0.05)
    return reports.salted_customer_summary(orders, _segments(t), n=8, hot=hot)


@query(
    "salted_join_random",
    f"SELECT o_orderkey AS order_id, c_mktsegment AS segment FROM orders JOIN customer ON c_custkey = {_FOLDED}",
)
def salted_join_random(t: Given):
    joined = skew.salted_join(_skewed(t), _segments(t), "customer_id", None, 4)
    return joined.select("order_id", "segment")


@query(
    "salted_totals",
    f"""
SELECT CAST({_FOLDED} AS VARCHAR) AS customer_id, CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS total
FROM orders GROUP BY 1
""",
)
def salted_totals(t: Given):
    salted = _skewed(t).withColumn("salt", F.pmod("order_id", F.lit(8)))
    return skew.salted_agg(salted, ["customer_id"], "salt", {"total": "amount"})
