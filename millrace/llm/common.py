"""What several operators share: tables, word and line patterns, keys of rows."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: What separates words, as a class of a Java regular expression and as code points.
SPACES = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_of(column: str) -> Column:
    """A null text counts as an empty one."""
    return F.coalesce(F.col(column), F.lit(""))


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, SPACES), lambda w: w != "")


def text_key(column: str) -> Column:
    """64 bits of a text, so that repeated ids with different texts stay apart; null and empty differ."""
    return F.xxhash64(F.col(column), F.length(F.col(column)))


def kept_rows(docs: DataFrame, verdicts: DataFrame, id: str, text: str) -> DataFrame:
    """The rows of ``docs`` whose id and text key are among ``verdicts`` (_id, _key), with all columns, whatever their names."""
    names = docs.columns
    held = [f"c{i}" for i in range(len(names))]
    key, body = held[names.index(id)], held[names.index(text)]
    keyed = docs.toDF(*held).withColumn("_k", text_key(body))
    hit = keyed[key].eqNullSafe(verdicts["_id"]) & (keyed["_k"] == verdicts["_key"])
    return keyed.join(verdicts.distinct().hint("merge"), hit, "left_semi").drop("_k").toDF(*names)


@contextmanager
def swept(spark: SparkSession) -> Iterator[None]:
    """Inside, the shuffle files of a query go when it has ended, not when the driver happens to collect garbage.

    For chains of large stages that are each written to the shared folder.  A frame that is run a second time shuffles anew.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if was is None else spark.conf.set(name, was)
