"""A total order over many tasks when one value, or one whole row, holds a large share of the rows.

A range sort by the key alone puts all rows of a value into one task.  Here splitters lie in (key, hash of the row, part), so
a value spans as many tasks as its rows need and the order still holds.  Equal rows are counted before they are sorted, which
is combined on the map side, and travel ``CHUNK`` as one: a task of the sort hands out at most so many times the rows that it
would have had without repeats.  Rows with more than ``HEAVY`` copies are dealt over the tasks before they are cut so small.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialise
from .fingerprint import row_hash

#: Equal rows that travel as one, and copies of a row that one task may cut into such.
CHUNK, HEAVY = 16, 1 << 20
_ROW_BITS = 33


def _cut(counted: DataFrame, size: int, per: int = 1) -> DataFrame:
    """Rows that stand for ``_n`` copies as rows that stand for at most ``size``, numbered in ``_part``."""
    whole = F.lit(size).cast("bigint")
    places = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_n") - 1) / whole))
    out = counted.withColumn("_i", F.explode(places))
    n, part = F.least(whole, F.col("_n") - F.col("_i") * whole), F.col("_part") * per + F.col("_i")
    return out.withColumn("_n", n).withColumn("_part", part).drop("_i")


def sample_sort(df: DataFrame, by: Sequence[str | Column], repeated: bool = True, chunk: int = CHUNK, heavy: int = HEAVY) -> DataFrame:
    """All rows in the order of ``by``, ties in the order of their hashes, over all tasks of the shuffle.

    ``repeated=False`` says that there are no large numbers of equal rows (an id is among the columns) and spares the count.
    The order is that of the rows as they are read or written next; a shuffle behind it ends it.  Of negative zeros and NaN
    in repeated rows only the value stays, as in grouping; maps cannot be grouped and need ``repeated=False``.
    """
    named = df.columns
    if not repeated:
        keyed = df.withColumn("_hash", row_hash(df))
        return keyed.orderBy(*by, "_hash").select(*named)
    heavy = max(heavy // chunk, 1) * chunk
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counted = df.groupBy(*named).agg(F.count(F.lit(1)).alias("_n"))
    counted = counted.withColumn("_hash", row_hash(df)).withColumn("_part", F.lit(0).cast("bigint"))
    # A fixed number of tasks: by their bytes these few rows would be put back into one.
    many = _cut(counted.filter(F.col("_n") > heavy), heavy).repartition(tasks, "_hash", "_part")
    parts = _cut(counted.filter(F.col("_n") <= heavy).unionByName(many), chunk, heavy // chunk)
    ordered = parts.orderBy(*by, "_hash", "_part")
    return ordered.withColumn("_copy", F.explode(F.array_repeat(F.lit(True), F.col("_n").cast("int")))).select(*named)


def positions(df: DataFrame, by: Sequence[str | Column], name: str = "position", repeated: bool = True) -> DataFrame:
    """Rows numbered from 1 in the order of ``by`` over the whole table, without a window that holds it.

    The sorted rows are written once with their place in their task; what the tasks before hold is a running sum over
    one row per task.
    """
    ordered = sample_sort(df, by, repeated)
    staged = materialise(ordered.withColumn("_at", F.monotonically_increasing_id()), label="ordered")
    task, place = F.shiftright("_at", _ROW_BITS), F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    sizes = staged.groupBy(task.alias("_task")).agg(F.count(F.lit(1)).alias("_n"))
    before = W.orderBy("_task").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("_task", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    numbered = staged.withColumn("_task", task).withColumn("_place", place).join(F.broadcast(offsets), "_task")
    return numbered.select(*df.columns, (F.col("_before") + F.col("_place") + 1).alias(name))
