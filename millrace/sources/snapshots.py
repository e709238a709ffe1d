"""Versions of a table kept as snapshot folders, and the audit between two of them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def version_path(root: str, version: int) -> str:
    return f"{root.rstrip('/')}/version={version}"


def write_version(df: DataFrame, root: str, version: int) -> None:
    """Replacing a version with the same input gives the same version."""
    df.write.mode("overwrite").parquet(version_path(root, version))


def read_version(spark: SparkSession, root: str, version: int, ddl: str) -> DataFrame:
    return spark.read.schema(ddl).parquet(version_path(root, version))


def snapshot_diff(cur: DataFrame, old: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """Rows present in both versions in which any of ``cols`` changed.

    Emits ``current_<c>`` and ``original_<c>`` per column, and ``<c>_diff`` for numeric ones.
    """
    kinds = dict(cur.dtypes)
    a = cur.select(*keys, *[F.col(c).alias(f"current_{c}") for c in cols])
    b = old.select(*keys, *[F.col(c).alias(f"original_{c}") for c in cols])
    changed = reduce(
        lambda x, y: x | y,
        [~F.col(f"current_{c}").eqNullSafe(F.col(f"original_{c}")) for c in cols],
    )
    out = a.join(b, keys).filter(changed)
    for c in cols:
        if kinds[c] in ("int", "bigint", "double", "float") or kinds[c].startswith("decimal"):
            out = out.withColumn(f"{c}_diff", F.col(f"current_{c}") - F.col(f"original_{c}"))
    return out
