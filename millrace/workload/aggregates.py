"""Aggregates, multi-grain reports, pivots and unpivots."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.timing import day_text
from ..functions.values import count_where, exact_avg, exact_sum, minor
from ..operators import grouping, lattice, ranking, reshape, states
from ..plans import reports
from ..sources.tables import cache_view, sql
from .registry import Given, query


@query(
    "order_summary",
    """
WITH p AS (SELECT l_returnflag, l_linestatus, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents, l_quantity FROM lineitem)
SELECT l_returnflag, l_linestatus, CAST(sum(cents) AS BIGINT) / 100.0 AS total,
       CAST((2 * sum(cents) + count(*)) // (2 * count(*)) AS BIGINT) / 100.0 AS average,
       min(l_quantity) AS least, max(l_quantity) AS most, count(*) AS n
FROM p GROUP BY ALL
""",
)
def order_summary(t: Given):
    return grouping.summarise(
        t.lineitem,
        ["l_returnflag", "l_linestatus"],
        {
            "total": exact_sum("l_extendedprice"),
            "average": exact_avg("l_extendedprice"),
            "least": F.min("l_quantity"),
            "most": F.max("l_quantity"),
            "n": F.count(F.lit(1)),
        },
    )


@query(
    "conditional_counts",
    """
SELECT l_suppkey, count(*) FILTER (l_quantity >= 25) AS big,
       count(CASE WHEN l_returnflag = 'R' THEN 1 END) AS returned,
       CAST(sum(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END) AS BIGINT) AS still_open
FROM lineitem GROUP BY ALL
""",
)
def conditional_counts(t: Given):
    return t.lineitem.groupBy("l_suppkey").agg(
        count_where(F.col("l_quantity") >= 25).alias("big"),
        F.count(F.when(F.col("l_returnflag") == "R", 1)).alias("returned"),
        F.sum(F.when(F.col("l_linestatus") == "O", 1).otherwise(0)).alias("still_open"),
    )


@query(
    "distinct_counts",
    """
SELECT l_returnflag, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_suppkey) AS suppliers, count(*) AS n
FROM lineitem GROUP BY ALL
""",
)
def distinct_counts(t: Given):
    return t.lineitem.groupBy("l_returnflag").agg(
        F.count_distinct("l_partkey").alias("parts"),
        F.count_distinct("l_suppkey").alias("suppliers"),
        F.count(F.lit(1)).alias("n"),
    )


@query(
    "bitmap_counts",
    """
SELECT l_returnflag, CAST(date_trunc('month', l_shipdate) AS DATE) AS month, count(DISTINCT CASE WHEN l_partkey % 3 <> 0 THEN l_partkey END) AS parts
FROM lineitem GROUP BY ALL
""",
)
def bitmap_counts(t: Given):
    """Exact distinct counts from states of bounded size: days first, then months put together from days."""
    part = F.when(F.col("l_partkey") % 3 != 0, F.col("l_partkey")).alias("part")
    lines = t.lineitem.select("l_returnflag", F.col("l_shipdate").cast("date").alias("day"), part)
    days = states.bitmap_states(lines, ["l_returnflag", "day"], "part")
    months = days.withColumn("month", F.trunc("day", "month"))
    return states.bitmap_counts(months, ["l_returnflag", "month"], "parts")


@query(
    "approx_devices",
    """
SELECT c_mktsegment AS device_model,
       floor(sum(CAST(value AS DECIMAL(18, 2))) * 100 / count(value) + 0.5) / 100 AS avg_signal,
       count(DISTINCT event_id) AS exact_events, true AS near_exact
FROM events JOIN customer ON c_custkey = user_id GROUP BY ALL
""",
)
def approx_devices(t: Given):
    """The sketch next to the exact count: within three of its standard errors."""
    devices = t.customer.select(F.col("c_custkey").alias("device_id"), F.col("c_mktsegment").alias("device_model"))
    events = t.events.select("event_id", F.col("user_id").alias("device_id"), F.col("value").alias("signal_strength"))
    sketched = reports.device_signals(events, devices)
    exact = events.join(devices, "device_id").groupBy("device_model").agg(F.count_distinct("event_id").alias("exact_events"))
    near = F.abs(F.col("total_events") - F.col("exact_events")) <= 3 * 0.05 * F.col("exact_events")
    return sketched.join(exact, "device_model").select("device_model", "avg_signal", "exact_events", near.alias("near_exact"))


@query(
    "fine_sums",
    """
SELECT event_type, CAST(sum(CAST(event_id % 1000 AS DECIMAL(38, 0))) / 100000000 AS DOUBLE) AS hundred_millionths,
       bool_or(event_id % 100 = 7 AND event_type = 'view') AS is_nan,
       CAST(CASE WHEN event_type <> 'view' THEN sum(CAST(event_id % 7 AS DECIMAL(38, 0))) END AS DOUBLE) AS whole
FROM events GROUP BY event_type
""",
)
def fine_sums(t: Given):
    """Eight decimals by declaration, and a NaN that shows."""
    tiny = (F.col("event_id") % 1000) / 1e8
    odd = F.when((F.col("event_type") == "view") & (F.col("event_id") % 100 == 7), float("nan")).otherwise((F.col("event_id") % 7).cast("double"))
    sums = t.events.groupBy("event_type").agg(exact_sum(tiny, scale=8).alias("hundred_millionths"), exact_sum(odd).alias("whole"))
    return sums.select("event_type", "hundred_millionths", F.isnan("whole").alias("is_nan"), F.when(~F.isnan("whole"), F.col("whole")).alias("whole"))


@query(
    "sorted_with_nulls",
    """
SELECT o_custkey, array_to_string([coalesce(x, '-') FOR x IN list_sort(l, 'ASC', 'NULLS FIRST')], '|') AS nulls_first,
       array_to_string([coalesce(x, '-') FOR x IN list_sort(l, 'ASC', 'NULLS LAST')], '|') AS nulls_last
FROM (SELECT o_custkey, list(CASE WHEN o_orderkey % 3 <> 0 THEN o_orderpriority END) AS l FROM orders GROUP BY ALL)
""",
)
def sorted_with_nulls(t: Given):
    """``sort_array`` puts NULLs first, ``array_sort`` last.  ``collect_list`` drops NULLs, so they travel in a struct."""
    known = F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderpriority"))
    lists = t.orders.groupBy("o_custkey").agg(F.transform(F.collect_list(F.struct(known.alias("p"))), lambda x: x["p"]).alias("l"))
    return lists.select(
        "o_custkey",
        F.array_join(F.sort_array("l"), "|", "-").alias("nulls_first"),
        F.array_join(F.array_sort("l"), "|", "-").alias("nulls_last"),
    )


@query(
    "cached_view_report",
    """
SELECT a.event_type, a.n, b.n_big FROM
  (SELECT event_type, count(*) AS n FROM events GROUP BY ALL) a
  JOIN (SELECT event_type, count(*) AS n_big FROM events WHERE value > 50 GROUP BY ALL) b USING (event_type)
""",
)
def cached_view_report(t: Given):
    counts = t.events.groupBy("event_type", (F.col("value") > 50).alias("big")).agg(F.count(F.lit(1)).alias("n"))
    hot = cache_view(t.spark, "event_counts", counts)
    return sql(
        t.spark,
        """
        SELECT a.event_type, a.n, b.n_big FROM
          (SELECT event_type, sum(n) AS n FROM {e} GROUP BY ALL) a
          JOIN (SELECT event_type, n AS n_big FROM {e} WHERE big) b USING (event_type)
        """,
        e=hot,
    )


@query(
    "collect_sorted",
    """
SELECT o_custkey, array_to_string(list_sort(list(DISTINCT o_orderpriority)), '|') AS priorities,
       count(o_orderpriority) AS n FROM orders GROUP BY ALL
""",
)
def collect_sorted(t: Given):
    found = grouping.collect_sorted(t.orders, ["o_custkey"], "o_orderpriority", "priorities", "n")
    return found.withColumn("priorities", F.array_join("priorities", "|"))


def _sales(t: Given):
    nations = t.nation.select(
        F.col("n_nationkey").alias("c_nationkey"),
        F.when(F.col("n_nationkey") % 6 != 0, F.concat(F.lit("R"), F.col("n_regionkey"))).alias("market"),
    )
    customers = t.customer.join(nations, "c_nationkey").select(F.col("c_custkey").alias("o_custkey"), "market")
    return t.orders.join(customers, "o_custkey").select(
        "market", F.col("o_orderpriority").alias("urgency"), F.col("o_totalprice").alias("amount"), "o_orderkey"
    )


_SALES = """
WITH sales AS (
  SELECT CASE WHEN n_nationkey % 6 <> 0 THEN 'R' || n_regionkey END AS market, o_orderpriority AS urgency,
         o_totalprice AS amount, o_orderkey % 9 + 1 AS units
  FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
)
"""


@query(
    "cube_report",
    _SALES
    + """
SELECT CASE WHEN grouping(market) = 1 THEN 'ALL' ELSE market END AS market,
       CASE WHEN grouping(urgency) = 1 THEN 'ALL' ELSE urgency END AS urgency,
       CASE grouping(market, urgency) WHEN 0 THEN 'market+urgency' WHEN 1 THEN 'market'
            WHEN 2 THEN 'urgency' ELSE 'grand_total' END AS level,
       CAST(sum(units) AS BIGINT) AS total_units
FROM sales GROUP BY CUBE (market, urgency)
""",
)
def cube_report(t: Given):
    return grouping.multi_grain(
        _sales(t).withColumn("units", F.col("o_orderkey") % 9 + 1),
        ["market", "urgency"],
        {"total_units": lattice.total("units")},
        levels={
            ("market", "urgency"): "market+urgency",
            ("market",): "market",
            ("urgency",): "urgency",
            (): "grand_total",
        },
    ).select("market", "urgency", "level", "total_units")


_SETS = (
    _SALES
    + """
SELECT concat_ws('+', if(grouping(market) = 0, 'market', NULL), if(grouping(urgency) = 0, 'urgency', NULL)) AS level,
       if(grouping(market) = 0, market, 'ALL') AS market, if(grouping(urgency) = 0, urgency, 'ALL') AS urgency,
       CAST(sum(CAST(amount AS DECIMAL(18, 2))) AS DOUBLE) AS revenue,
       count(*) FILTER (amount >= 100000) AS large_orders
FROM sales GROUP BY GROUPING SETS ((market, urgency), (market), (urgency))
"""
)
_DIMS = ["market", "urgency"]
_MEASURES = {
    "revenue": exact_sum,
    "large_orders": lambda c: count_where(F.col(c) >= 100000),
}


def _measures():
    return {name: make("amount") for name, make in _MEASURES.items()}


def _sets_report(t: Given, measures):
    return grouping.multi_grain(
        _sales(t),
        ["market", "urgency"],
        measures,
        grains=[["market", "urgency"], ["market"], ["urgency"]],
        levels={
            ("market", "urgency"): "market+urgency",
            ("market",): "market",
            ("urgency",): "urgency",
        },
    ).select("level", "market", "urgency", "revenue", "large_orders")


@query("grouping_sets_report", _SETS)
def grouping_sets_report(t: Given):
    """One shuffle, every row repeated for each grain: for grains that shrink little."""
    return _sets_report(t, _measures())


@query("grouping_sets_lattice", _SETS)
def grouping_sets_lattice(t: Given):
    """The same rolled up from the groups of the finest grain."""
    return _sets_report(t, {"revenue": lattice.exact("amount"), "large_orders": lattice.rows_where(F.col("amount") >= 100000)})


_SHIPMENTS = """
SELECT CASE WHEN grouping(line) = 1 THEN 'ALL' ELSE CAST(line AS VARCHAR) END AS line,
       CASE WHEN grouping(month) = 1 THEN 'ALL' ELSE CAST(month AS VARCHAR) END AS month,
       CASE WHEN grouping(flag) = 1 THEN 'ALL' ELSE flag END AS flag,
       count(*) AS n_lines, CAST(sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS DOUBLE) AS revenue,
       CAST(min(l_quantity) AS DOUBLE) AS least, CAST(max(l_quantity) AS DOUBLE) AS most,
       count(DISTINCT l_suppkey) AS suppliers, count(DISTINCT l_partkey) AS parts, CAST(grouping(line, month, flag) AS BIGINT) AS grain_id
FROM (SELECT *, l_linenumber AS line, CAST(date_trunc('month', l_shipdate) AS DATE) AS month,
             CASE WHEN l_orderkey % 11 <> 0 THEN l_returnflag END AS flag FROM lineitem)
GROUP BY {grains}
"""


def _shipments(t: Given, grains):
    rows = t.lineitem.withColumns(
        {"line": F.col("l_linenumber"), "month": F.trunc("l_shipdate", "month"), "flag": F.when(F.col("l_orderkey") % 11 != 0, F.col("l_returnflag"))}
    )
    quantity = F.col("l_quantity").cast("double")
    measures = {
        "n_lines": lattice.rows(),
        "revenue": lattice.exact("l_extendedprice"),
        "least": lattice.low("quantity"),
        "most": lattice.high("quantity"),
        "suppliers": lattice.distinct("l_suppkey"),
        "parts": lattice.distinct("l_partkey"),
    }
    return grouping.multi_grain(rows.withColumn("quantity", quantity), ["line", "month", "flag"], measures, grains)


@query("lattice_cube", _SHIPMENTS.format(grains="CUBE (line, month, flag)"))
def lattice_cube(t: Given):
    """Eight grains over an int, a date and a dimension with NULLs, with two distinct counts."""
    return _shipments(t, "cube")


@query("lattice_rollup", _SHIPMENTS.format(grains="ROLLUP (line, month, flag)"))
def lattice_rollup(t: Given):
    return _shipments(t, "rollup")


@query("cube_then_filter", _SETS)
def cube_then_filter(t: Given):
    raw = grouping.cube_then_filter(_sales(t), _DIMS, _measures(), drop_ids=[3])
    rolled = {d: F.col("grain_id").bitwiseAND(F.lit(2 >> i)) != 0 for i, d in enumerate(_DIMS)}
    level = F.concat_ws("+", *[F.when(~rolled[d], F.lit(d)) for d in _DIMS])
    shown = [F.when(rolled[d], "ALL").otherwise(F.col(d)).alias(d) for d in _DIMS]
    return raw.select(level.alias("level"), *shown, "revenue", "large_orders")


@query("grouping_sets_sql", _SETS)
def grouping_sets_sql(t: Given):
    """The text is put together from the dimensions and the grains."""
    dims, grains = ["market", "urgency"], [["market", "urgency"], ["market"], ["urgency"]]
    level = ", ".join(f"IF(grouping({d}) = 0, '{d}', NULL)" for d in dims)
    shown = ", ".join(f"IF(grouping({d}) = 0, {d}, 'ALL') AS {d}" for d in dims)
    sets = ", ".join(f"({', '.join(g)})" for g in grains)
    measures = "CAST(sum(CAST(amount AS DECIMAL(18, 2))) AS DOUBLE) AS revenue, count_if(amount >= 100000) AS large_orders"
    text = f"SELECT concat_ws('+', {level}) AS level, {shown}, {measures} FROM {{sales}} GROUP BY GROUPING SETS ({sets})"
    return sql(t.spark, text, sales=_sales(t))


@query(
    "rollup_report",
    _SALES
    + """
SELECT CASE WHEN grouping(market) = 1 THEN 'ALL_MARKETS' ELSE market END AS market,
       CASE WHEN grouping(urgency) = 1 THEN 'ALL_URGENCIES' ELSE urgency END AS urgency,
       CAST(sum(CAST(amount AS DECIMAL(18, 2))) AS DOUBLE) AS total_revenue,
       CAST(grouping(market, urgency) AS BIGINT) AS agg_level_id
FROM sales GROUP BY ROLLUP (market, urgency)
""",
)
def rollup_report(t: Given):
    report = grouping.multi_grain(
        _sales(t),
        ["market", "urgency"],
        {"total_revenue": lattice.exact("amount")},
        grains="rollup",
        all_labels={"market": "ALL_MARKETS", "urgency": "ALL_URGENCIES"},
    ).withColumnRenamed("grain_id", "agg_level_id")
    return report.orderBy("agg_level_id", "market", "urgency")


_FLAGS = ["A", "N", "R"]
_PIVOT = """
SELECT l_suppkey,
       coalesce(CAST(sum(CASE WHEN l_returnflag = 'A' THEN CAST(l_quantity AS DECIMAL(18, 2)) END) AS DOUBLE), 0) AS A,
       coalesce(CAST(sum(CASE WHEN l_returnflag = 'N' THEN CAST(l_quantity AS DECIMAL(18, 2)) END) AS DOUBLE), 0) AS N,
       coalesce(CAST(sum(CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS DECIMAL(18, 2)) END) AS DOUBLE), 0) AS R
FROM lineitem GROUP BY l_suppkey
"""


@query("pivot_sum", _PIVOT)
def pivot_sum(t: Given):
    return grouping.pivot_sum(
        t.lineitem, ["l_suppkey"], "l_returnflag", _FLAGS, exact_sum("l_quantity"), fill=0
    )


@query("pivot_by_condition", _PIVOT)
def pivot_by_condition(t: Given):
    return grouping.pivot_by_condition(t.lineitem, ["l_suppkey"], "l_returnflag", _FLAGS, "l_quantity")


@query("pivot_sql", _PIVOT)
def pivot_sql(t: Given):
    lines = t.lineitem.select("l_suppkey", "l_returnflag", minor("l_quantity").alias("q"))
    return sql(
        t.spark,
        """
        SELECT l_suppkey, coalesce(A, 0) / 100D AS A, coalesce(N, 0) / 100D AS N,
               coalesce(R, 0) / 100D AS R
        FROM {lines} PIVOT (sum(q) FOR l_returnflag IN ('A', 'N', 'R'))
        """,
        lines=lines,
    )


@query(
    "pivot_subset",
    """
SELECT o_custkey, count(*) FILTER (o_orderpriority = '1-URGENT') AS urgent,
       count(*) FILTER (o_orderpriority = '5-LOW') AS low
FROM orders GROUP BY o_custkey
""",
)
def pivot_subset(t: Given):
    wide = grouping.pivot_sum(
        t.orders, ["o_custkey"], "o_orderpriority", ["1-URGENT", "5-LOW"], F.count(F.lit(1)), fill=0
    )
    return wide.withColumnsRenamed({"1-URGENT": "urgent", "5-LOW": "low"})


@query(
    "pivot_dynamic",
    """
SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS F, count(*) FILTER (o_orderstatus = 'O') AS O,
       count(*) FILTER (o_orderstatus = 'P') AS P
FROM orders GROUP BY ALL
""",
)
def pivot_dynamic(t: Given):
    return grouping.pivot_dynamic(t.orders, ["o_orderpriority"], "o_orderstatus", F.count(F.lit(1)))


@query(
    "pivot_multi",
    """
SELECT o_custkey,
       CAST(sum(CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(18, 2)) END) AS DOUBLE) AS F_total,
       nullif(count(*) FILTER (o_orderstatus = 'F'), 0) AS F_n,
       CAST(sum(CASE WHEN o_orderstatus = 'O' THEN CAST(o_totalprice AS DECIMAL(18, 2)) END) AS DOUBLE) AS O_total,
       nullif(count(*) FILTER (o_orderstatus = 'O'), 0) AS O_n
FROM orders GROUP BY ALL
""",
)
def pivot_multi(t: Given):
    return grouping.pivot_multi(
        t.orders,
        ["o_custkey"],
        "o_orderstatus",
        ["F", "O"],
        {"total": exact_sum("o_totalprice"), "n": F.count(F.lit(1))},
    )


def _wide(t: Given):
    priority = F.col("o_orderpriority")
    amount = F.col("o_totalprice")

    def total(label: str, name: str):
        return exact_sum(F.when(priority == label, amount)).alias(name)

    return t.orders.groupBy("o_custkey").agg(
        total("1-URGENT", "urgent"), total("2-HIGH", "high"), total("5-LOW", "low")
    )


_WIDE = """
WITH wide AS (
  SELECT o_custkey,
    CAST(sum(CASE WHEN o_orderpriority = '1-URGENT' THEN CAST(o_totalprice AS DECIMAL(18, 2)) END) AS DOUBLE) AS urgent,
    CAST(sum(CASE WHEN o_orderpriority = '2-HIGH' THEN CAST(o_totalprice AS DECIMAL(18, 2)) END) AS DOUBLE) AS high,
    CAST(sum(CASE WHEN o_orderpriority = '5-LOW' THEN CAST(o_totalprice AS DECIMAL(18, 2)) END) AS DOUBLE) AS low
  FROM orders GROUP BY ALL
)
"""
_LONG = """
SELECT o_custkey, 'urgent' AS priority, urgent AS amount FROM wide
UNION ALL SELECT o_custkey, 'high', high FROM wide
UNION ALL SELECT o_custkey, 'low', low FROM wide
"""
_COLS = ["urgent", "high", "low"]


@query("melt", _WIDE + _LONG)
def melt(t: Given):
    return reshape.melt(_wide(t), ["o_custkey"], _COLS, "priority", "amount")


@query("melt_stack", _WIDE + _LONG)
def melt_stack(t: Given):
    return reshape.melt(_wide(t), ["o_custkey"], _COLS, "priority", "amount", route="stack")


@query("melt_sql_no_nulls", _WIDE + f"SELECT * FROM ({_LONG}) WHERE amount IS NOT NULL")
def melt_sql_no_nulls(t: Given):
    return reshape.unpivot_sql(_wide(t), ["o_custkey"], _COLS, "priority", "amount")


@query("melt_sql_nulls", _WIDE + _LONG)
def melt_sql_nulls(t: Given):
    return reshape.unpivot_sql(_wide(t), ["o_custkey"], _COLS, "priority", "amount", include_nulls=True)


@query(
    "melt_groups",
    """
WITH two AS (
  SELECT o_custkey,
    CAST(sum(CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(18, 2)) END) AS DOUBLE) AS f_total,
    nullif(count(*) FILTER (o_orderstatus = 'F'), 0) AS f_n,
    CAST(sum(CASE WHEN o_orderstatus = 'O' THEN CAST(o_totalprice AS DECIMAL(18, 2)) END) AS DOUBLE) AS o_total,
    nullif(count(*) FILTER (o_orderstatus = 'O'), 0) AS o_n
  FROM orders GROUP BY ALL
)
SELECT * FROM (
  SELECT o_custkey, 'F' AS status, f_total AS total, f_n AS n FROM two
  UNION ALL SELECT o_custkey, 'O', o_total, o_n FROM two
) WHERE total IS NOT NULL OR n IS NOT NULL
""",
)
def melt_groups(t: Given):
    wide = pivot_multi(t)
    groups = {"F": ["F_total", "F_n"], "O": ["O_total", "O_n"]}
    return reshape.melt_groups(wide, ["o_custkey"], groups, "status", ["total", "n"])


@query(
    "argmax_order",
    """
SELECT o_custkey, o_orderkey, o_orderdate FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey ASC) = 1
""",
)
def argmax_order(t: Given):
    order = [F.col("o_totalprice"), -F.col("o_orderkey")]
    return ranking.argbest(t.orders, ["o_custkey"], order, ["o_orderkey", "o_orderdate"])


@query(
    "argmax_with_default",
    """
WITH urgent AS (SELECT * FROM orders WHERE o_orderpriority = '1-URGENT'),
best AS (
  SELECT * FROM urgent QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice, o_orderstatus) = 1
)
SELECT c_custkey AS o_custkey, coalesce(o_orderstatus, 'UNKNOWN') AS o_orderstatus
FROM customer LEFT JOIN best ON o_custkey = c_custkey
""",
)
def argmax_with_default(t: Given):
    urgent = t.orders.filter(F.col("o_orderpriority") == "1-URGENT")
    everyone = t.customer.select(F.col("c_custkey").alias("o_custkey"))
    order = [F.col("o_totalprice")]
    return ranking.argbest_or_default(
        urgent, ["o_custkey"], order, ["o_orderstatus"], everyone, ["UNKNOWN"], how="min"
    )


@query(
    "boolean_aggs",
    """
SELECT l_orderkey, bool_and(l_quantity >= 5) AS all_big, bool_or(l_returnflag = 'R') AS any_returned,
       bool_and(CASE WHEN l_linestatus = 'O' THEN l_quantity >= 5 END) AS open_big
FROM lineitem GROUP BY ALL
""",
)
def boolean_aggs(t: Given):
    big = F.col("l_quantity") >= 5
    return t.lineitem.groupBy("l_orderkey").agg(
        F.bool_and(big).alias("all_big"),
        F.bool_or(F.col("l_returnflag") == "R").alias("any_returned"),
        F.bool_and(F.when(F.col("l_linestatus") == "O", big)).alias("open_big"),
    )


@query(
    "tolerant_aggs",
    """
SELECT o_custkey, CASE WHEN abs(sum(CAST(big AS HUGEINT))) <= 9223372036854775807 THEN CAST(sum(CAST(big AS HUGEINT)) AS BIGINT) END AS total,
       CASE WHEN sum(late) <> 0 THEN CAST(count(*) AS DOUBLE) / CAST(sum(late) AS DOUBLE) END AS per_late
FROM (
  SELECT o_custkey, CASE WHEN o_orderkey % 5 = 0 THEN 6000000000000000000 ELSE o_orderkey END AS big,
         CASE WHEN o_orderstatus = 'F' AND o_orderkey % 8 = 0 THEN 1 ELSE 0 END AS late FROM orders
) GROUP BY ALL
""",
)
def tolerant_aggs(t: Given):
    big = F.when(F.col("o_orderkey") % 5 == 0, F.lit(6_000_000_000_000_000_000)).otherwise(F.col("o_orderkey"))
    late = F.when((F.col("o_orderstatus") == "F") & (F.col("o_orderkey") % 8 == 0), 1).otherwise(0)
    return t.orders.groupBy("o_custkey").agg(
        F.try_sum(big).alias("total"), F.try_divide(F.count(F.lit(1)), F.sum(late)).alias("per_late")
    )


@query(
    "having_on_key",
    """
SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY ALL HAVING o_orderpriority <> '5-LOW' AND count(*) > 10
""",
)
def having_on_key(t: Given):
    counted = t.orders.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    return counted.filter((F.col("o_orderpriority") != "5-LOW") & (F.col("n") > 10))


@query(
    "distinct_forms",
    """
SELECT o_custkey, CAST(o_orderdate AS VARCHAR)[1:10] AS day, count(*) AS n FROM orders GROUP BY ALL
""",
)
def distinct_forms(t: Given):
    days = t.orders.select("o_custkey", day_text("o_orderdate").alias("day"))
    once = days.distinct().join(days.dropDuplicates(["o_custkey", "day"]), ["o_custkey", "day"])
    grouped = days.groupBy("o_custkey", "day").agg(F.count(F.lit(1)).alias("n"))
    return once.join(grouped, ["o_custkey", "day"])


@query(
    "daily_activity",
    """
WITH raw AS (
  SELECT CASE WHEN event_id % 13 <> 0 THEN user_id END AS user_id, event_type, CAST(ts AS DATE) AS event_date,
         CASE WHEN event_id % 6 = 0 THEN -value WHEN event_id % 7 <> 0 THEN value END AS price FROM events
)
SELECT event_date, count(DISTINCT user_id) AS dau, count(*) FILTER (event_type = 'purchase') AS purchase_count,
       CAST(sum(CAST(CASE WHEN price < 0 THEN 0.0 ELSE price END AS DECIMAL(18, 2))) AS DOUBLE) AS total_revenue
FROM raw WHERE user_id IS NOT NULL GROUP BY ALL
""",
)
def daily_activity(t: Given):
    slashed = F.col("event_id") % 2 == 0
    raw = t.events.select(
        F.when(F.col("event_id") % 13 != 0, F.col("user_id")).alias("user_id"),
        F.when(slashed, F.date_format("ts", "yyyy/MM/dd")).otherwise(day_text("ts")).alias("event_time"),
        "event_type",
        F.when(F.col("event_id") % 6 == 0, -F.col("value"))
        .when(F.col("event_id") % 7 != 0, F.col("value"))
        .alias("price"),
    )
    return reports.daily_activity(raw)


@query(
    "set_operations",
    """
SELECT kind, count(*) AS n FROM (
  SELECT 'customer' AS kind, c_nationkey AS k FROM customer
  UNION ALL SELECT 'supplier', s_nationkey FROM supplier
  UNION ALL SELECT 'customer', c_nationkey FROM customer WHERE c_acctbal < 0
) GROUP BY ALL
""",
)
def set_operations(t: Given):
    customers = t.customer.select(F.lit("customer").alias("kind"), F.col("c_nationkey").alias("k"), "c_acctbal")
    suppliers = t.supplier.select(F.col("s_nationkey").alias("k"), F.lit("supplier").alias("kind"))
    poor = customers.filter(F.col("c_acctbal") < 0).drop("c_acctbal")
    every = customers.drop("c_acctbal").unionByName(suppliers).union(poor)
    return every.groupBy("kind").agg(F.count(F.lit(1)).alias("n"))
