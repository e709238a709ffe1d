"""Distinct counts kept as states that can be stored and merged: bitmaps, which are exact, and sketches.

A bitmap state has a row per key and ``BITS`` consecutive ids, of ``BITS / 8`` bytes however many rows went in.  A sketch
state has a row per key, of ``2 ** lg`` registers, whose estimates have a relative standard error of about
``1.04 / sqrt(2 ** lg)``.  Sketches are built with a partial aggregate, so a key that holds a third of the rows sends one
state per task.  Bitmaps of few ids are far larger than the ids: distinct ids travel, spread evenly, and each bitmap is
built once, from at most ``BITS`` of them.  Both are united in any order, any number of times, with the same result, which
is what allows them to be stored by day and put together into longer windows later, without the events.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.timing import cell_of, width_us
from ..session import materialise

#: Ids of a bitmap: fixed by the built-in bitmap functions.
BITS = 32_768
#: Ids of a word, as which bitmaps are counted.
_WORD = 64


def bitmap_states(df: DataFrame, keys: Sequence[str | Column], col: str) -> DataFrame:
    """keys, ``bucket``, ``bits`` of an integer column.  A key whose values are all NULL has an empty bitmap."""
    ids = df.select(*keys, F.bitmap_bucket_number(col).alias("bucket"), F.bitmap_bit_position(col).alias("_bit")).distinct()
    place = ids.columns[:-1]
    # Dealt by state before the aggregate: no task sends bitmaps, one for each state it has an id of.
    return ids.repartition(*place).groupBy(*place).agg(F.bitmap_construct_agg("_bit").alias("bits"))


def bitmap_union(states: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    return states.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def bitmap_counts(states: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Exact distinct counts.

    Bitmaps are united word by word, without the words that are zero: whole bitmaps of few ids shrink some fifty times on
    their way, and a task whose share is measured by what arrives would have to sort that many times its share.
    """
    word, size = F.explode(F.sequence(F.lit(0), F.lit(BITS // _WORD - 1))).alias("_word"), F.lit(_WORD // 8)
    words = states.select(*keys, "bucket", "bits", word)
    words = words.withColumn("bits", F.substring("bits", F.col("_word") * size + 1, size))
    # The first word stays, so that keys without ids do.
    words = words.filter((F.col("_word") == 0) | (F.col("bits") != F.lit(bytes(_WORD // 8))))
    united = words.groupBy(*keys, "bucket", "_word").agg(F.bit_or(F.conv(F.hex("bits"), 16, -10).cast("bigint")).alias("bits"))
    return united.groupBy(*keys).agg(F.sum(F.bit_count("bits").cast("bigint")).alias(name))


def sketch_states(df: DataFrame, keys: Sequence[str | Column], col: str, lg: int = 12) -> DataFrame:
    """keys, ``sketch`` of an integer, string or binary column."""
    return df.groupBy(*keys).agg(F.hll_sketch_agg(col, lg).alias("sketch"))


def sketch_union(states: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    return states.groupBy(*keys).agg(F.hll_union_agg("sketch").alias("sketch"))


def sketch_counts(states: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Estimated distinct counts."""
    return sketch_union(states, keys).select(*keys, F.hll_sketch_estimate("sketch").alias(name))


def slide_of(at: str, slide: timedelta, name: str = "slide") -> Column:
    """The start of the slide an instant lies in, by which states are kept."""
    return F.timestamp_micros(cell_of(at, slide)).cast("timestamp_ntz").alias(name)


def windows_of(states: DataFrame, span: timedelta, slide: timedelta, name: str = "slide") -> DataFrame:
    """States under each window of ``span`` that their slide belongs to: ``window_start`` and ``window_end`` replace the slide.

    Only states are repeated, ``span / slide`` times; events never are.
    """
    n, rest = divmod(width_us(span), width_us(slide))
    if rest:
        raise ValueError("a window is made of whole slides")
    starts = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.col(name) - F.make_dt_interval(secs=i * (width_us(slide) // 1_000_000)))
    out = states.withColumn("window_start", F.explode(starts)).drop(name)
    return out.withColumn("window_end", F.col("window_start") + F.make_dt_interval(secs=F.lit(width_us(span) // 1_000_000)))


def vocabulary(df: DataFrame, col: str, most: int = BITS) -> DataFrame | None:
    """The distinct values of a column with numbers from 0 on, written to the shared folder; None beyond ``most`` values.

    So many values fit one bitmap, and a table of them is small enough to broadcast.
    """
    values = df.select(col).filter(F.col(col).isNotNull()).distinct()
    if values.limit(most + 1).count() > most:
        return None
    numbered = values.withColumn("_no", F.row_number().over(W.orderBy(col)) - 1)
    return materialise(numbered, label="vocabulary")
