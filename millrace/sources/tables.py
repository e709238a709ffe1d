"""Typed sources and relation registration."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Declared schemas of the given tables.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
        "l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """Parquet scan with a declared schema; nothing is inferred."""
    return spark.read.schema(ddl).parquet(path)


def given(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return table(spark, f"{folder}/{name}.parquet", SCHEMAS[name])


def parquet_stream(spark: SparkSession, folder: str, ddl: str, only: str | None = None) -> DataFrame:
    reader = spark.readStream.schema(ddl)
    if only:
        reader = reader.option("pathGlobFilter", only)
    return reader.parquet(folder)


def json_stream(spark: SparkSession, folder: str, ddl: str, files_per_batch: int | None = None) -> DataFrame:
    """Unbounded JSON directory with an explicit schema."""
    reader = spark.readStream.schema(ddl)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(folder)


def sql(spark: SparkSession, text: str, **frames: DataFrame) -> DataFrame:
    """SQL text over DataFrames passed as ``{name}``: no global view names to collide."""
    return spark.sql(text, **frames)


def register(**frames: DataFrame) -> None:
    """Temp views for SQL that has to name its relations."""
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)


def cache_view(spark: SparkSession, name: str, frame: DataFrame) -> DataFrame:
    """Register and cache a hot relation (lazily) for several SQL consumers."""
    frame.createOrReplaceTempView(name)
    spark.sql(f"CACHE LAZY TABLE {name}")
    return spark.table(name)


def date_axis(spark: SparkSession, first: date, last: date, name: str = "d") -> DataFrame:
    """Every date from first to last, both included."""
    days = F.sequence(F.lit(first), F.lit(last))
    return spark.range(1).select(F.explode(days).alias(name))


def number_axis(spark: SparkSession, n: int, first: date, name: str = "d") -> DataFrame:
    """The next n dates, counted from a number source."""
    return spark.range(n).select(F.date_add(F.lit(first), F.col("id").cast("int")).alias(name))
