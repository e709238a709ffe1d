"""Row-wise operators: no shuffle in any of them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.parsing import parse_day
from ..functions.values import tidy_key


def project(df: DataFrame, spec: Mapping[str, str | Column]) -> DataFrame:
    """Output columns in exactly this order: ``{output name: source column or expression}``."""
    cols = [(F.col(src) if isinstance(src, str) else src).alias(out) for out, src in spec.items()]
    return df.select(*cols)


def in_range(df: DataFrame, col: str, lo: float, hi: float) -> DataFrame:
    """Drop readings below lo, above hi, or unknown."""
    return df.filter(F.col(col).between(lo, hi))


def zero_fill(df: DataFrame, fills: Mapping[str, object]) -> DataFrame:
    """Replace NULL by a literal of the column's own type."""
    kinds = dict(df.dtypes)
    return df.withColumns(
        {c: F.coalesce(F.col(c), F.lit(v).cast(kinds[c])) for c, v in fills.items()}
    )


def normalise_keys(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: tidy_key(c) for c in cols})


def clean_events(df: DataFrame, user: str, at: str, price: str, day: str = "event_date") -> DataFrame:
    """Drop rows without a user, parse the day from either format, lift negative prices to zero."""
    known = df.filter(F.col(user).isNotNull())
    return known.withColumns(
        {day: parse_day(at), price: F.when(F.col(price) < 0, F.lit(0.0)).otherwise(F.col(price))}
    )


def route(
    df: DataFrame,
    rules: Sequence[tuple[str, Column]],
    payload: Mapping[str, Column] | None = None,
    reason: str = "reject_reason",
    status: str = "load_status",
    passed: str = "ACCEPTED",
    held: str = "QUARANTINED",
) -> DataFrame:
    """First rule that fires names the reason; status and payload both follow from that one decision."""
    decision = F.lit(None).cast("string")
    if rules:
        label, cond = rules[0]
        decision = F.when(cond, F.lit(label))
        for label, cond in rules[1:]:
            decision = decision.when(cond, F.lit(label))
    decided = df.withColumn(reason, decision)
    ok = F.col(reason).isNull()
    out = {status: F.when(ok, F.lit(passed)).otherwise(F.lit(held))}
    for name, value in (payload or {}).items():
        out[name] = F.when(ok, value)
    return decided.withColumns(out)
