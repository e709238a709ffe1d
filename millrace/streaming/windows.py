"""Watermarked aggregates and deduplication."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.values import exact_sum


def tumbling_sales(
    stream: DataFrame,
    at: str = "event_time",
    order: str = "order_id",
    amount: str = "amount",
    window: str = "10 minutes",
    lateness: str = "20 minutes",
) -> DataFrame:
    """Sales and orders per tumbling window; rows later than the watermark are not waited for."""
    return (
        stream.withWatermark(at, lateness)
        .groupBy(F.window(at, window).alias("time_window"))
        .agg(
            exact_sum(amount, 2).alias("total_sales"),
            F.count(order).alias("order_count"),
        )
    )


def tumbling_sales_sql(
    stream: DataFrame,
    at: str = "event_time",
    order: str = "order_id",
    amount: str = "amount",
    window: str = "10 minutes",
    lateness: str = "20 minutes",
) -> DataFrame:
    """The same in SQL.  The watermark has to be on the stream before it becomes a view."""
    view = f"sales_{uuid.uuid4().hex}"
    stream.withWatermark(at, lateness).createOrReplaceTempView(view)
    return stream.sparkSession.sql(
        f"""
        SELECT window({at}, '{window}') AS time_window,
               CAST(round(
                 CAST(sum(floor({amount})) AS DECIMAL(20, 0))
                 + CAST(sum(CAST(rint(({amount} - floor({amount})) * 1e6D) AS BIGINT)) AS DECIMAL(20, 0)) * 0.000001,
                 2) AS DOUBLE) AS total_sales,
               count({order}) AS order_count
        FROM {view}
        GROUP BY window({at}, '{window}')
        """
    )


def open_window(df: DataFrame, window: str = "time_window") -> DataFrame:
    """Window struct as two plain columns."""
    rest = [c for c in df.columns if c != window]
    return df.select(
        F.col(f"{window}.start").alias("window_start"), F.col(f"{window}.end").alias("window_end"), *rest
    )


def rolling_uv(
    df: DataFrame,
    key: str,
    at: str,
    user: str,
    span: str = "7 days",
    slide: str = "1 day",
    name: str = "rolling_uv",
) -> DataFrame:
    """Exact distinct users per key and sliding window.

    A window is made of whole slides, so users are made distinct per slide first.  Only those rows are
    repeated for the ``span / slide`` windows they belong to.
    """
    slides = df.select(key, F.window(at, slide)["start"].alias("_slide"), user).distinct()
    return (
        slides.groupBy(key, F.window("_slide", span, slide).alias("_w"))
        .agg(F.count_distinct(user).alias(name))
        .select(
            key, F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), name
        )
    )


def rolling_uv_stream(
    stream: DataFrame,
    key: str,
    at: str,
    user: str,
    span: str = "7 days",
    slide: str = "1 day",
    lateness: str = "1 day",
    name: str = "rolling_uv",
) -> DataFrame:
    """On a stream the distinct count is a sketch: exact sets are not combinable state there."""
    return (
        stream.withWatermark(at, lateness)
        .groupBy(key, F.window(at, span, slide).alias("_w"))
        .agg(F.approx_count_distinct(user).alias(name))
        .select(
            key, F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), name
        )
    )


def dedup_stream(stream: DataFrame, keys: list[str], at: str, lateness: str) -> DataFrame:
    """First arrival per payload key; state is kept only as long as the watermark allows repeats."""
    return stream.withWatermark(at, lateness).dropDuplicatesWithinWatermark(keys)
