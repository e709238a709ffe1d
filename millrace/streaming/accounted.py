"""Event-time aggregates that account for every row: on time and counted, or late and kept with the reason.

Each micro-batch is folded into the state that the batch before left, and writes its own folders: what is still open, what
can no longer change, the rows that came too late, and one row of accounts.  A batch reads its own rows, the last open
state and the last account, never older ones, and writing it again replaces it, so a batch that is lost in the middle runs
again with the same outcome.

The watermark of a batch is the latest event time of the batches before, less the lateness; it never goes back.  Every
batch must count exactly the rows that were not late, or it fails before it is committed.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timing import cell_of, epoch_us, width_us
from ..functions.values import exact_parts, exact_value
from ..operators.quality import Gates, check
from ..operators.timeline import cell_summaries
from .sinks import by_batch, finish, written

_ACCOUNT = "top timestamp_ntz, watermark timestamp_ntz, n_in bigint, n_late bigint, n_counted bigint"


@dataclass(frozen=True)
class Accounted:
    """``rows``: the aggregate, open and closed.  ``late``: late rows with ``reason`` and ``watermark``.  ``accounts``: one
    row per batch, of which ``n_in = n_counted + n_late``."""

    rows: DataFrame
    late: DataFrame
    accounts: DataFrame


def run(
    stream: DataFrame,
    root: str,
    at: str,
    lateness: timedelta,
    fold: Callable[[DataFrame, DataFrame | None], DataFrame],
    is_late: Callable[[Column], Column],
    is_closed: Callable[[Column], Column],
) -> Accounted:
    """``fold(rows, open)`` gives the state after the rows, with their number in ``n``.  ``is_late`` and ``is_closed`` judge a
    row and a state against a watermark; a closed state must be out of reach of every row that is not late."""
    spark = stream.sparkSession
    fields = stream.schema
    empty = spark.createDataFrame([], fields)
    state = fold(empty, None).schema
    account = spark.createDataFrame([], _ACCOUNT).schema

    def of(session: SparkSession, kind: str, batch_id: int, schema: T.StructType) -> DataFrame:
        return session.read.schema(schema).parquet(f"{root}/{kind}/batch={batch_id}")

    def write(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        put = lambda df, kind: df.write.mode("overwrite").parquet(f"{root}/{kind}/batch={batch_id}")
        put(batch, "landed")
        landed = of(session, "landed", batch_id, fields)
        before = of(session, "accounts", batch_id - 1, account).first() if batch_id else None
        mark: datetime | None = before["top"] - lateness if before and before["top"] else None
        level = F.lit(mark).cast("timestamp_ntz")
        no_time, behind = F.col(at).isNull(), F.coalesce(is_late(level), F.lit(False))
        reason = F.when(no_time, "no time").when(behind, "behind the watermark")
        put(landed.filter(no_time | behind).select("*", reason.alias("reason"), level.alias("watermark")), "late")
        was_open = of(session, "open", batch_id - 1, state) if batch_id else None
        put(fold(landed.filter(~no_time & ~behind), was_open), "folded")
        folded = of(session, "folded", batch_id, state)
        found = landed.agg(F.max(at).cast("timestamp_ntz"), F.count(F.lit(1)), F.count_if(no_time | behind)).first()
        tops = [x for x in (found[0], before["top"] if before else None) if x]
        top = max(tops) if tops else None
        held = was_open.agg(F.sum("n")).first()[0] if was_open is not None else 0
        counted = found[1] - found[2]
        check(folded, Gates(totals={"rows on time": (F.sum("n"), counted + (held or 0))}))
        closed = F.coalesce(is_closed(F.lit(top - lateness if top else None).cast("timestamp_ntz")), F.lit(False))
        put(folded.filter(closed), "closed")
        put(folded.filter(~closed), "open")
        put(session.createDataFrame([(top, mark, found[1], found[2], counted)], account), "accounts")

    finish(stream.writeStream.foreachBatch(write), f"{root}/cp")
    late = T.StructType([*fields.fields, T.StructField("reason", T.StringType()), T.StructField("watermark", T.TimestampNTZType())])
    accounts = written(spark, f"{root}/accounts", by_batch(account))
    newest = accounts.agg(F.max("batch")).first()[0]
    still = written(spark, f"{root}/open", by_batch(state)).filter(F.col("batch") == F.lit(-1 if newest is None else newest))
    rows = written(spark, f"{root}/closed", by_batch(state)).unionByName(still).drop("batch")
    return Accounted(rows, written(spark, f"{root}/late", by_batch(late)), accounts)


def run_sessions(
    stream: DataFrame, root: str, keys: Sequence[str], at: str, gap: timedelta, lateness: timedelta
) -> Accounted:
    """Sessions as ``timeline.gap_sessions`` finds them in the rows that were not late, merged as rows arrive.

    A row in between joins two open sessions.  A row is late when it is older than the watermark, and a session closes when
    no other row can reach it.  Rows become cells as wide as the gap before they meet the open sessions of their key.
    """
    wide = F.lit(width_us(gap))
    beyond = lambda a, b: F.timestamp_diff("MICROSECOND", a, b) > wide

    def fold(rows: DataFrame, was_open: DataFrame | None) -> DataFrame:
        timed = rows.withColumn(at, F.col(at).cast("timestamp_ntz"))
        parts = cell_summaries(timed, keys, at, gap).select(
            *keys, F.col("_first").alias("session_start"), F.col("_last").alias("session_end"), F.col("_n").alias("n")
        )
        parts = parts if was_open is None else parts.unionByName(was_open)
        order = W.partitionBy(*keys).orderBy("session_start", "session_end")
        reach = F.max("session_end").over(order.rowsBetween(W.unboundedPreceding, -1))
        opens = (reach.isNull() | beyond(reach, F.col("session_start"))).cast("int")
        number = F.sum("_opens").over(order.rowsBetween(W.unboundedPreceding, W.currentRow))
        tagged = parts.withColumn("_opens", opens).withColumn("_session", number)
        return tagged.groupBy(*keys, "_session").agg(
            F.min("session_start").alias("session_start"), F.max("session_end").alias("session_end"), F.sum("n").alias("n")
        ).drop("_session")

    return run(
        stream,
        root,
        at,
        lateness,
        fold,
        is_late=lambda level: F.col(at).cast("timestamp_ntz") < level,
        is_closed=lambda level: beyond(F.col("session_end"), level),
    )


def run_tumbling(
    stream: DataFrame, root: str, at: str, amount: str, window: timedelta, lateness: timedelta, scale: int = 2
) -> Accounted:
    """``window_start``, ``window_end``, ``n``, ``total`` of an amount per tumbling window.

    A row is late when its window has ended by the watermark, as in Spark's own windowed aggregates, which drop it.
    """
    span = f"{width_us(window)} microseconds"
    parts = ["_whole", "_units", "_odd"]

    def fold(rows: DataFrame, was_open: DataFrame | None) -> DataFrame:
        timed = rows.withColumn("_w", F.window(F.col(at).cast("timestamp_ntz"), span))
        sums = [p.alias(n) for p, n in zip(exact_parts(amount, scale), parts)]
        new = timed.groupBy(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end")).agg(F.count(F.lit(1)).alias("n"), *sums)
        if was_open is None:
            return new
        return new.unionByName(was_open).groupBy("window_start", "window_end").agg(*[F.sum(c).alias(c) for c in ["n", *parts]])

    found = run(
        stream,
        root,
        at,
        lateness,
        fold,
        # In microseconds: a window column would silently leave out the rows without a time.
        is_late=lambda level: cell_of(at, window) + width_us(window) <= epoch_us(level),
        is_closed=lambda level: F.col("window_end") <= level,
    )
    total = exact_value(*[F.col(p) for p in parts], scale=scale)
    return Accounted(found.rows.select("window_start", "window_end", "n", total.alias("total")), found.late, found.accounts)
