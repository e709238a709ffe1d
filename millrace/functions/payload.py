"""Query-string payloads (``a=1&b=2``): native expressions, and the UDF forms that mirror them."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNKNOWN = "UNKNOWN"
SHAPE = T.StructType(
    [T.StructField("n_params", T.IntegerType()), T.StructField("user_tier", T.StringType())]
)


def n_params(payload: str) -> Column:
    """How many pairs; 0 for NULL and for the empty string."""
    text = F.coalesce(F.col(payload), F.lit(""))
    return F.when(text == "", F.lit(0)).otherwise(F.size(F.split(text, "&")))


def param(payload: str, key: str, default: str = UNKNOWN) -> Column:
    """Upper-cased value of ``key``; the default only when the key is absent.

    A repeated key counts with its last value, and text without ``=`` is no key.
    """
    lead = f"{key}="
    own = F.filter(F.split(F.coalesce(F.col(payload), F.lit("")), "&"), lambda p: p.startswith(lead))
    value = F.substring(F.try_element_at(own, F.lit(-1)), len(lead) + 1, 1 << 30)
    return F.coalesce(F.upper(value), F.lit(default))


def _pairs(payload: str | None) -> dict[str, str]:
    if not payload:
        return {}
    return dict(p.split("=", 1) for p in payload.split("&") if "=" in p)


def _summary(payload: str | None) -> tuple[int, str]:
    if not payload:
        return 0, UNKNOWN
    return len(payload.split("&")), _pairs(payload).get("tier", UNKNOWN).upper()


def payload_udfs():
    """The Python forms: count, tier, and both in one pass.  Arrow-batched transport."""
    count = F.udf(lambda p: _summary(p)[0], T.IntegerType(), useArrow=True)
    tier = F.udf(lambda p: _summary(p)[1], T.StringType(), useArrow=True)
    both = F.udf(_summary, SHAPE, useArrow=True)
    return count, tier, both


def register_payload_udfs(spark: SparkSession) -> None:
    """Make the Python forms callable from SQL text."""
    count, tier, _ = payload_udfs()
    spark.udf.register("payload_count", count)
    spark.udf.register("payload_tier", tier)
