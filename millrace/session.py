"""Session contract, shared scratch space and materialisation.

Every operator assumes ANSI mode and a UTC session time zone.  Anything that must outlive a lost
executor is written to the folder the cluster names in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CONTRACT = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(app: str = "millrace", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**CONTRACT, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_session(spark: SparkSession) -> SparkSession:
    """Apply the contract to a session somebody else built."""
    for key, value in CONTRACT.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession, label: str) -> str:
    """A new, unused folder path that all executors can reach."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.gettempdir()
    return f"{base.rstrip('/')}/millrace/{label}-{uuid.uuid4().hex}"


def discard(staged: DataFrame) -> None:
    """Remove the folders behind a frame of what ``materialise`` wrote, a union of several included."""
    spark = staged.sparkSession
    for folder in {os.path.dirname(f) for f in staged.inputFiles()}:
        if "/millrace/" in folder:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialise(df: DataFrame, how: str = "table", label: str = "stage") -> DataFrame:
    """Compute a forked intermediate once.

    ``table`` writes parquet to the shared folder and reads it back: the lineage is cut, later reads
    prune columns, and losing executors loses nothing.  ``checkpoint`` is the same without a columnar
    layout.  ``persist`` keeps lineage and is meant for small, short-lived forks.
    """
    spark = df.sparkSession
    if how == "table":
        path = shared_dir(spark, label)
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)
    if how == "checkpoint":
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(shared_dir(spark, "checkpoint"))
        return df.checkpoint(eager=True)
    if how == "persist":
        return df.persist()
    raise ValueError(f"unknown materialisation {how!r}")
