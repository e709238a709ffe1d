"""Partition-aligned parquet output and a census of what was written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_partitioned(
    df: DataFrame, path: str, keys: list[str], spread: str | None = None, files_per_folder: int = 1
) -> None:
    """Write one file per partition folder; a rerun replaces only the folders it produces.

    A folder holding a large share of the rows would be one task.  ``spread`` names a stable integer
    column whose remainder splits every folder over ``files_per_folder`` tasks.  The number of tasks is
    fixed to the session's, or small folders would be packed into one task that writes them in turn.
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if files_per_folder == 1:
        placed = df.repartition(tasks, *keys)
    else:
        if spread is None:
            raise ValueError("name the column to spread by")
        placed = df.repartition(tasks, *keys, F.pmod(F.col(spread), F.lit(files_per_folder)))
    (
        placed.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys)
        .parquet(path)
    )


def partition_census(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Files and rows per partition folder, counted from the data files themselves."""
    return (
        spark.read.parquet(path)
        .groupBy(*keys, F.col("_metadata.file_path").alias("file"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n_files"), F.sum("rows").alias("n_rows"))
    )
