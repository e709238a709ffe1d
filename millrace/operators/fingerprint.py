"""Fingerprints of tables as multisets: what a rerun, a copy or a version is compared by, one aggregate per side.

The fingerprint of rows is their number, the sum of their 64-bit hashes (in three lanes that cannot overflow below 2 ** 41
rows) and the exclusive or of a second hash.  It does not depend on the order or the partitioning, counts multiplicities, and
adds up: fingerprints of parts, merged, are that of the whole.  Two tables that differ have equal ones with a probability of
about 2 ** -64 per comparison; nobody who can choose the rows is kept out.

NULL is a value, in a column as in a struct, an array or a map, and its place counts.  Negative zero is zero and all NaN are
one value, as in grouping.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LANE = 22


@dataclass(frozen=True)
class Fingerprint:
    """``shape``: names and types; the rest as in ``parts``."""

    shape: tuple[tuple[str, str], ...]
    rows: int
    low: int
    mid: int
    high: int
    mixed: int


def _named(name: str) -> Column:
    return F.col(f"`{name.replace('`', '``')}`")


def _whole(c: Column, kind: T.DataType) -> Column:
    """A nested value as something whose hash shows where its NULLs are, and in which a map has one order."""
    if isinstance(kind, T.MapType):
        pairs = F.transform(F.map_entries(c), lambda e: F.struct(e["key"].alias("key"), e["value"].alias("value")))
        return F.to_json(F.struct(F.array_sort(F.transform(pairs, _text))), {"ignoreNullFields": "false"})
    if isinstance(kind, (T.ArrayType, T.StructType)):
        return _text(F.struct(c))
    return c


def _text(c: Column) -> Column:
    return F.to_json(c, {"ignoreNullFields": "false"})


def row_hash(df: DataFrame, cols: Sequence[str] | None = None, seed: int = 0) -> Column:
    """64 bits of a row; a NULL in one column is not a NULL in another."""
    names = list(df.columns if cols is None else cols)
    values = [_whole(_named(c), df.schema[c].dataType) for c in names]
    return F.xxhash64(F.lit(seed), *values, *[_named(c).isNull() for c in names])


def parts(df: DataFrame, cols: Sequence[str] | None = None) -> list[Column]:
    """The aggregates ``rows``, ``low``, ``mid``, ``high``, ``mixed``, for a whole table or for groups of its rows."""
    h, ones = row_hash(df, cols), F.lit((1 << LANE) - 1)
    lane = lambda i: F.shiftrightunsigned(h, LANE * i).bitwiseAND(ones)
    zero = lambda c: F.coalesce(c, F.lit(0).cast("bigint"))
    return [
        F.count(F.lit(1)).alias("rows"),
        *[zero(F.sum(lane(i))).alias(name) for i, name in enumerate(("low", "mid", "high"))],
        zero(F.bit_xor(row_hash(df, cols, seed=1))).alias("mixed"),
    ]


def merged() -> list[Column]:
    """``parts`` of groups put together."""
    zero = lambda c: F.coalesce(c, F.lit(0).cast("bigint"))
    sums = [zero(F.sum(c)).alias(c) for c in ("rows", "low", "mid", "high")]
    return [*sums, zero(F.bit_xor("mixed")).alias("mixed")]


def fingerprint(df: DataFrame) -> Fingerprint:
    """One aggregate over the table; one row comes to the driver."""
    return Fingerprint(tuple(df.dtypes), *df.agg(*parts(df)).first())


def same_multiset(a: DataFrame, b: DataFrame) -> bool:
    """Both have the same columns and hold the same rows with the same multiplicity."""
    return a.dtypes == b.dtypes and fingerprint(a) == fingerprint(b)
