"""Hashed folders, fingerprints and total orders, over data derived from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import ordering, quality
from ..session import shared_dir
from ..sources import folders
from .registry import Given, query

_LATE, _FOLDERS = "1998-06-01", 16


@query(
    "folder_diff",
    f"""
SELECT o_orderkey AS order_id, o_totalprice + 1 AS current_price, o_totalprice AS original_price,
       (o_totalprice + 1) - o_totalprice AS price_diff
FROM orders WHERE o_orderdate >= TIMESTAMP '{_LATE}'
""",
)
def folder_diff(t: Given):
    """Two versions of all orders; the late ones cost one more in the second."""
    root, late = shared_dir(t.spark, "order_versions"), F.col("o_orderdate") >= F.lit(_LATE).cast("timestamp_ntz")
    first = t.orders.select(F.col("o_orderkey").alias("order_id"), F.col("o_totalprice").alias("price"))
    second = t.orders.select(
        F.col("o_orderkey").alias("order_id"), F.when(late, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")).alias("price")
    )
    folders.write_version(first, root, 0, ["order_id"], _FOLDERS)
    folders.write_version(second, root, 1, ["order_id"], _FOLDERS)
    return folders.diff_versions(t.spark, root, 1, 0, "order_id bigint, price double", ["order_id"], ["price"], _FOLDERS)


_STATE = "customer_id bigint, email string, tier string, updated_at timestamp_ntz"


@query(
    "folder_upserts",
    """
WITH every_row AS (
  SELECT c_custkey AS customer_id, 'S' AS op, c_name AS email, c_mktsegment AS tier, TIMESTAMP '1990-01-01' AS updated_at
  FROM customer
  UNION ALL
  SELECT o_custkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 'D' ELSE 'U' END, 'order-' || o_orderkey, o_orderpriority,
         o_orderdate
  FROM orders
), latest AS (
  SELECT * FROM every_row
  QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY updated_at DESC, op DESC, email DESC, tier DESC) = 1
)
SELECT customer_id, email, tier, updated_at FROM latest WHERE op <> 'D'
""",
)
def folder_upserts(t: Given):
    """Customers, changed by all orders, the newer half first: what comes late changes nothing that is newer."""
    root = shared_dir(t.spark, "customer_state")
    state = t.customer.select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("email"),
        F.col("c_mktsegment").alias("tier"),
        F.lit("1990-01-01").cast("timestamp_ntz").alias("updated_at"),
    )
    changes = t.orders.select(
        F.col("o_custkey").alias("customer_id"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "D").otherwise("U").alias("op"),
        F.concat(F.lit("order-"), F.col("o_orderkey")).alias("email"),
        F.col("o_orderpriority").alias("tier"),
        F.col("o_orderdate").alias("updated_at"),
    )
    keys, cols, at = ["customer_id"], ["email", "tier"], "updated_at"
    folders.write_state(state, root, keys, folders=_FOLDERS)
    newer = F.col(at) >= F.lit("1996-01-01").cast("timestamp_ntz")
    for batch in (changes.filter(newer), changes.filter(~newer)):
        folders.apply_to_state(batch, root, _STATE, keys, cols, at, folders=_FOLDERS)
    return folders.read_state(t.spark, root, _STATE, folders=_FOLDERS)


@query(
    "rerun_difference",
    f"""
SELECT l_partkey, l_quantity, count(*) AS surplus FROM lineitem WHERE l_shipdate >= TIMESTAMP '{_LATE}' GROUP BY ALL
""",
)
def rerun_difference(t: Given):
    """What a rerun that misses the late lines lacks, with multiplicities; a whole one passes the gate."""
    whole = t.lineitem.select("l_partkey", "l_quantity")
    part = t.lineitem.filter(F.col("l_shipdate") < F.lit(_LATE).cast("timestamp_ntz")).select("l_partkey", "l_quantity")
    if not quality.same_rows(whole, whole.repartition(7, "l_quantity")) or quality.same_rows(whole, part):
        raise quality.GateError("fingerprints")
    return quality.differing_rows(whole, part)


@query(
    "order_positions",
    """
SELECT o_orderpriority, o_orderkey, row_number() OVER (ORDER BY o_orderpriority, o_orderkey) AS position FROM orders
""",
)
def order_positions(t: Given):
    rows = t.orders.select("o_orderpriority", "o_orderkey")
    return ordering.positions(rows, ["o_orderpriority", "o_orderkey"], repeated=False)


@query(
    "tied_positions",
    """
WITH counts AS (SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY ALL)
SELECT l_returnflag, l_linestatus, n,
       CAST(sum(n) OVER (ORDER BY l_returnflag, l_linestatus) - n + 1 AS BIGINT) AS first_position,
       CAST(sum(n) OVER (ORDER BY l_returnflag, l_linestatus) AS BIGINT) AS last_position
FROM counts
""",
)
def tied_positions(t: Given):
    """Half of these rows are equal: they span tasks, and the order holds."""
    rows = t.lineitem.select("l_returnflag", "l_linestatus")
    placed = ordering.positions(rows, ["l_returnflag", "l_linestatus"])
    return placed.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"), F.min("position").alias("first_position"), F.max("position").alias("last_position")
    )
