"""Run a stream over everything available, into files that survive a restart.

Every micro-batch writes under its own batch id, and writing a batch again replaces it.  So a replayed
batch changes nothing, whichever executor was lost.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.quality import Gates, check, counted
from ..operators.ranking import keep_latest
from ..operators.upserts import apply_changes
from ..plans.facts import resolve_trips


#: Keyed state beyond an executor's memory: kept on its disk, its changes in the checkpoint.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def finish(writer, checkpoint: str) -> None:
    """Everything that is there now, then stop."""
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def written(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """What the batches have written so far; a stream without any data has written nothing."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def by_batch(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("batch", T.LongType())])


def run_append(result: DataFrame, root: str) -> DataFrame:
    """Append mode into a parquet sink: only rows that can no longer change."""
    finish(result.writeStream.outputMode("append").format("parquet").option("path", f"{root}/out"), f"{root}/cp")
    return written(result.sparkSession, f"{root}/out", result.schema)


def run_updates(result: DataFrame, root: str, keys: Sequence[str]) -> DataFrame:
    """Update mode: each batch writes the rows it changed; the last batch to touch a key counts."""
    fields = result.schema

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/out/batch={batch_id}")

    finish(result.writeStream.outputMode("update").foreachBatch(write), f"{root}/cp")
    rows = written(result.sparkSession, f"{root}/out", by_batch(fields))
    return keep_latest(rows, keys, ["batch"]).select(*fields.names)


def run_upserts(
    changes: DataFrame,
    root: str,
    keys: Sequence[str],
    cols: Sequence[str],
    at: str,
    op: str = "op",
    compact_every: int = 16,
) -> None:
    """Collapse each micro-batch to the last change per key and keep it as a delta.

    A batch costs its own size, never the size of the state; ``upserted`` merges on read.  Every
    ``compact_every`` batches all deltas so far are folded into one base, so a read meets one base and fewer
    deltas than that, however long the stream has run.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        shape = batch.select(*keys, op, *cols, at).schema
        last = keep_latest(batch.select(*shape.names), keys, [at])
        last.write.mode("overwrite").parquet(f"{root}/delta/batch={batch_id}")
        if (batch_id + 1) % compact_every == 0:
            folded = keep_latest(_deltas(batch.sparkSession, root, shape, batch_id), keys, [at])
            folded.write.mode("overwrite").parquet(f"{root}/base/upto={batch_id}")

    finish(changes.writeStream.foreachBatch(write), f"{root}/cp")


def _deltas(spark: SparkSession, root: str, shape: T.StructType, until: int | None = None) -> DataFrame:
    """Changes so far (before batch ``until`` ended): the newest base and the deltas after it."""
    named = lambda name: T.StructType([*shape.fields, T.StructField(name, T.LongType())])
    bases = written(spark, f"{root}/base", named("upto"))
    deltas = written(spark, f"{root}/delta", named("batch"))
    if until is not None:  # a base of this very batch is what is being written anew
        bases, deltas = bases.filter(F.col("upto") < until), deltas.filter(F.col("batch") <= until)
    newest = bases.agg(F.max("upto")).first()[0]
    newest = -1 if newest is None else newest
    old = bases.filter(F.col("upto") == newest).select(*shape.names)
    return old.unionByName(deltas.filter(F.col("batch") > newest).select(*shape.names))


def upserted(
    spark: SparkSession, seed: DataFrame, root: str, keys: Sequence[str], cols: Sequence[str], at: str, op: str = "op"
) -> DataFrame:
    """State after all changes.  Tombstones are remembered, so an old change cannot revive a key."""
    shape = seed.select(*keys, F.lit("").alias(op), *cols, at).schema
    return apply_changes(seed, _deltas(spark, root, shape), keys, cols, at, op)


def first_landings(stream: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Of each key the row that landed first, within a batch the smallest; rows without a key are all kept.

    The state holds each key's first row under the time of its batch, which a batch that runs again keeps.  A key is handed
    out by the batch that first saw it and never again, and a batch touches the keys of its own rows only.
    """
    ranked = [x for c in cols for x in (F.col(c).isNull().alias(f"_no_{c}"), F.col(c))]
    first = F.min(F.struct("_landed", *ranked)).alias("_first")
    known = stream.filter(F.col(key).isNotNull()).withColumn("_landed", F.current_timestamp()).groupBy(key).agg(first)
    fresh = known.filter(F.col("_first._landed") == F.current_timestamp())
    fresh = fresh.select(key, *[F.col(f"_first.{c}").alias(c) for c in cols])
    return fresh.unionByName(stream.filter(F.col(key).isNull()).select(key, *cols))


def run_resolution(
    trips: DataFrame,
    root: str,
    dims: Callable[[SparkSession], tuple[DataFrame, DataFrame]],
) -> DataFrame:
    """Park and replay: each batch offers its own trips and everything still pending.

    The dimensions are read anew per batch.  Returns all published trips and what is pending at the end.
    A trip that is sent again, in its batch or a later one, is the trip it was: the first that landed counts,
    within a batch the smallest row.  Trips without an id cannot be told apart, so each of them is kept.
    Which ids were seen is keyed state: a batch reads its own trips and what is pending, never older landings.
    Every batch settles exactly the trips it was offered, or fails before it is committed.
    """
    spark = trips.sparkSession
    last: list[int] = []
    park = ["trip_id", "driver_id", "completed_ts", "fare_cents", "first_seen_date"]
    shape = trips.select(*park).schema

    def write(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        # Written once: a second look at the batch would run the state's step again.
        batch.write.mode("overwrite").parquet(f"{root}/landed/batch={batch_id}")
        offered = session.read.schema(shape).parquet(f"{root}/landed/batch={batch_id}")
        if batch_id > 0:
            held = session.read.schema(settled_shape).parquet(f"{root}/resolved/batch={batch_id - 1}")
            offered = offered.unionByName(held.filter(F.col("load_status") == "PENDING").select(*park))
        offered, before = counted(offered, {"rows": F.count(F.lit(1))})
        staged = f"{root}/resolved/batch={batch_id}"
        resolve_trips(offered, *dims(session), keep=["completed_ts"]).write.mode("overwrite").parquet(staged)
        settled = session.read.schema(settled_shape).parquet(staged)
        gates = Gates(totals={"offered trips": (F.count(F.lit(1)), lambda: before("rows"))})
        check(settled, gates)
        last.append(batch_id)

    settled_shape = resolve_trips(spark.createDataFrame([], shape), *dims(spark), keep=["completed_ts"]).schema
    fresh = first_landings(trips.select(*park), "trip_id", park[1:])
    was = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    try:
        finish(fresh.writeStream.outputMode("update").foreachBatch(write), f"{root}/cp")
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", was)
    history = written(spark, f"{root}/resolved", by_batch(settled_shape))
    newest = max(last) if last else history.agg(F.max("batch")).first()[0]
    done = (F.col("load_status") == "PUBLISHED") | (F.col("batch") == newest)
    return history.filter(done).drop("batch", "completed_ts")
