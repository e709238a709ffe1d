"""Keyed tables in hashed folders, so that versions are compared and changed by the folders that differ.

A key lies in the folder of its hash.  The number of folders is chosen once, is part of the path, and bounds what the driver
gets to see: numbers of folders, never keys or rows.

``write_version``, ``changed_folders``, ``diff_versions``: each version carries a fingerprint per folder; only folders whose
fingerprints differ are read and joined.  A version without changes costs no row.

``write_state``, ``apply_to_state``, ``read_state``: changes are applied to the folders that hold their keys, and only those
are written anew, by dynamic partition overwrite.  Rows of a folder are staged by Spark's commit and moved when all tasks are
through; a run that broke off is repaired by running the same batch again, which changes nothing that it had done.
Deleted keys stay as tombstones, so a change that comes late cannot revive them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import fingerprint
from ..operators.upserts import apply_changes_kept
from .snapshots import snapshot_diff, version_path

FOLDER = "folder"
FOLDERS = 256


def folder_of(keys: Sequence[str], folders: int) -> Column:
    """NULL keys lie in a folder as well."""
    return F.pmod(F.xxhash64(*keys, *[F.col(k).isNull() for k in keys]), F.lit(folders)).cast("int")


def _placed(df: DataFrame, keys: Sequence[str], folders: int, tasks: int | None = None) -> DataFrame:
    """One task per folder that has rows: keys are unique and their hashes even, so no folder is large."""
    dealt = df.withColumn(FOLDER, folder_of(keys, folders))
    return dealt.repartition(tasks or folders, FOLDER)


def _root(root: str, folders: int) -> str:
    return f"{root.rstrip('/')}/of-{folders}"


def _read(spark: SparkSession, path: str, ddl: str, only: Sequence[int] | None = None) -> DataFrame:
    """Rows of a folder table; with ``only``, the files of those folders and no others."""
    rows = spark.read.schema(f"{ddl}, {FOLDER} int").parquet(path)
    return rows if only is None else rows.filter(F.col(FOLDER).isin(list(only)))


def write_version(df: DataFrame, root: str, version: int, keys: Sequence[str], folders: int = FOLDERS) -> None:
    """A version and the fingerprints of its folders.  Writing the same input again gives the same version.

    Fingerprints are taken from what was written, and written last: a version without them is not one.
    """
    path = version_path(_root(root, folders), version)
    _placed(df, keys, folders).write.mode("overwrite").partitionBy(FOLDER).parquet(f"{path}/rows")
    held = df.sparkSession.read.schema(df.withColumn(FOLDER, F.lit(0)).schema).parquet(f"{path}/rows")
    marks = held.groupBy(FOLDER).agg(*fingerprint.parts(held, df.columns))
    marks.coalesce(1).write.mode("overwrite").parquet(f"{path}/marks")


def read_version(
    spark: SparkSession, root: str, version: int, ddl: str, folders: int = FOLDERS, only: Sequence[int] | None = None
) -> DataFrame:
    return _read(spark, f"{version_path(_root(root, folders), version)}/rows", ddl, only).drop(FOLDER)


def version_mark(spark: SparkSession, root: str, version: int, folders: int = FOLDERS):
    """The fingerprint of a whole version, from those of its folders."""
    marks = spark.read.parquet(f"{version_path(_root(root, folders), version)}/marks")
    return marks.agg(*fingerprint.merged()).first()


def changed_folders(spark: SparkSession, root: str, cur: int, old: int, folders: int = FOLDERS) -> list[int]:
    """Folders whose rows differ between two versions: at most ``folders`` numbers, from as many rows of each."""
    a, b = (
        spark.read.parquet(f"{version_path(_root(root, folders), v)}/marks").select(FOLDER, F.struct("rows", "low", "mid", "high", "mixed").alias(name))
        for v, name in ((cur, "a"), (old, "b"))
    )
    differ = a.join(b, FOLDER, "full_outer").filter(~F.col("a").eqNullSafe(F.col("b")))
    return sorted(r[0] for r in differ.select(FOLDER).collect())


def diff_versions(
    spark: SparkSession, root: str, cur: int, old: int, ddl: str, keys: list[str], cols: list[str], folders: int = FOLDERS
) -> DataFrame:
    """``snapshot_diff`` of two versions over the folders that differ; all others hold the same rows."""
    only = changed_folders(spark, root, cur, old, folders)
    a, b = (read_version(spark, root, v, ddl, folders, only) for v in (cur, old))
    return snapshot_diff(a, b, keys, cols)


def write_state(df: DataFrame, root: str, keys: Sequence[str], op: str = "op", folders: int = FOLDERS) -> None:
    """A new state of live rows."""
    live = df.withColumn(op, F.lit("S"))
    _placed(live, keys, folders).write.mode("overwrite").partitionBy(FOLDER).parquet(_root(root, folders))


def _state_ddl(ddl: str, op: str) -> str:
    return f"{ddl}, {op} string"


def read_state(
    spark: SparkSession, root: str, ddl: str, op: str = "op", delete: str = "D", folders: int = FOLDERS
) -> DataFrame:
    """Rows that are not deleted, with the columns of ``ddl``."""
    return _read(spark, _root(root, folders), _state_ddl(ddl, op)).filter(F.col(op) != delete).drop(op, FOLDER)


def apply_to_state(
    changes: DataFrame,
    root: str,
    ddl: str,
    keys: Sequence[str],
    cols: Sequence[str],
    at: str,
    op: str = "op",
    delete: str = "D",
    folders: int = FOLDERS,
) -> int:
    """Apply a batch of changes; the number of folders that were written anew is returned.

    Per key the latest change counts if it is strictly newer than what is held, a tombstone included.
    """
    spark = changes.sparkSession
    touched = sorted(r[0] for r in changes.select(folder_of(keys, folders).alias(FOLDER)).distinct().collect())
    if not touched:
        return 0
    held = _read(spark, _root(root, folders), _state_ddl(ddl, op), touched).drop(FOLDER)
    after = apply_changes_kept(held, changes, keys, cols, at, op)
    shape = [*held.columns]
    placed = _placed(after.select(*shape), keys, folders, len(touched))
    placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(FOLDER).parquet(_root(root, folders))
    return len(touched)
