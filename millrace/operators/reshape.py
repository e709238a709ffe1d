"""Wide to long."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def melt(
    df: DataFrame,
    ids: Sequence[str],
    values: Sequence[str],
    var: str,
    val: str,
    keep_nulls: bool = True,
    route: str = "unpivot",
) -> DataFrame:
    """One row per (row, value column).

    Value columns must share a type; int and double widen to double, int and string are an error.
    ``stack`` is the generator form with the same rows.  ``keep_nulls=False`` is SQL ``UNPIVOT``.
    """
    if route == "unpivot":
        long = df.unpivot(list(ids), list(values), var, val)
    elif route == "stack":
        cells = [c for v in values for c in (F.lit(v), F.col(v))]
        long = df.select(*ids, F.stack(F.lit(len(values)), *cells).alias(var, val))
    else:
        raise ValueError(f"unknown route {route!r}")
    return long if keep_nulls else long.filter(F.col(val).isNotNull())


def melt_groups(
    df: DataFrame,
    ids: Sequence[str],
    groups: Mapping[str, Sequence[str]],
    var: str,
    vals: Sequence[str],
    keep_nulls: bool = False,
) -> DataFrame:
    """Several measures per group: ``{label: columns}``.  A row goes only if all measures are NULL."""
    cells = [c for label, cols in groups.items() for c in (F.lit(label), *[F.col(x) for x in cols])]
    long = df.select(*ids, F.stack(F.lit(len(groups)), *cells).alias(var, *vals))
    if keep_nulls:
        return long
    return long.filter(F.coalesce(*[F.col(v).cast("string") for v in vals]).isNotNull())


def unpivot_sql(
    df: DataFrame, ids: Sequence[str], values: Sequence[str], var: str, val: str, include_nulls: bool = False
) -> DataFrame:
    """The ``UNPIVOT`` clause, NULL cells excluded unless asked for."""
    mode = "INCLUDE NULLS" if include_nulls else "EXCLUDE NULLS"
    narrow = df.select(*ids, *values)
    return df.sparkSession.sql(
        f"SELECT * FROM {{wide}} UNPIVOT {mode} ({val} FOR {var} IN ({', '.join(values)}))", wide=narrow
    )
