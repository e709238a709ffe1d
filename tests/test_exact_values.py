"""Sums that keep every declared decimal, and dimensions of any type."""

import math
import random
from datetime import date, datetime
from decimal import Decimal

import pytest
from helpers import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from millrace.functions.values import exact_avg, exact_sum, exact_total, minor
from millrace.operators import grouping, quality, skew, timeline
from millrace.session import shared_dir


def test_small_values_are_summed_or_refused(spark):
    df = spark.range(1000).select(F.lit(4e-7).alias("v"))
    assert df.agg(exact_sum("v", scale=8)).first()[0] == 4e-4
    with pytest.raises(PySparkException, match="more than 6 decimals"):
        df.agg(exact_sum("v")).collect()
    with pytest.raises(PySparkException, match="more than 2 decimals"):
        spark.range(3).select(minor(F.lit(0.004))).collect()
    noisy = spark.createDataFrame([(0.1 + 0.2,), (1234567.1 * 3,)], "v double")  # digits that doubles do not hold
    assert noisy.agg(exact_sum("v")).first()[0] == 3703701.6


@pytest.mark.parametrize("v", [4e-10, -4e-10, 9e-6, -9e-6, 1e-17, 1e-300, 123456.0000009])
def test_nothing_is_rounded_away(spark, v):
    """Either the declared decimals hold the value and the sum is exact, or there is an error."""
    df = spark.range(1000).select(F.lit(v).alias("v"))
    for scale in (2, 6):
        if round(v, scale) != v:
            for bad in (df.agg(exact_sum("v", scale=scale)), df.agg(exact_avg("v", scale=scale)), df.select(minor("v", scale)), df.agg(exact_total("v", scale))):
                with pytest.raises(PySparkException, match=f"more than {scale} decimals"):
                    bad.collect()
    digits = {4e-10: 10, 9e-6: 6, 123456.0000009: 7}.get(abs(v))
    if digits:
        assert df.agg(exact_sum("v", scale=digits)).first()[0] == round(1000 * v, digits)
        assert df.select(minor("v", digits).alias("u")).agg(F.sum("u")).first()[0] == 1000 * round(v * 10**digits)
        timed = df.withColumn("k", F.lit(1)).withColumn("at", F.lit("2025-01-01").cast("timestamp_ntz"))
        total = timeline.running_total(timed, ["k"], "at", "v", "t", scale=digits)
        assert total.agg(F.max(F.abs("t"))).first()[0] == abs(1000 * round(v * 10**digits)) / 10**digits


def test_what_doubles_do_not_hold_is_no_digit(spark):
    r = random.Random(4)
    values = [round(r.choice([1, -1]) * r.random() * 10 ** r.randrange(0, 9), r.randrange(0, 7)) for _ in range(3000)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    want = sum((Decimal(repr(v)) for v in values), Decimal(0))
    assert df.agg(exact_total("v")).first()[0] == want
    assert df.select(minor("v", 6).alias("u")).agg(F.sum("u")).first()[0] == int(want * 10**6)


def test_not_finite_values_show(spark):
    df = spark.createDataFrame([(1.5,), (float("nan"),), (None,)], "v double")
    assert all(math.isnan(x) for x in df.agg(exact_sum("v"), exact_avg("v"), exact_sum("v", 2)).first())
    assert spark.createDataFrame([(1.0,), (float("-inf"),)], "v double").agg(exact_sum("v")).first()[0] == float("-inf")
    with pytest.raises(PySparkException, match="not a finite number"):
        df.agg(exact_total("v")).collect()
    salted = df.select(F.lit("k").alias("k"), F.lit(0).alias("s"), "v")
    assert math.isnan(skew.salted_agg(salted, ["k"], "s", {"v": "v"}).first()["v"])


def test_running_totals_keep_or_refuse_fine_values(spark):
    data = [(i, datetime(2025, 1, 1, 0, 0, i % 60), 0.004) for i in range(1000)]
    df = spark.createDataFrame(data, "id int, at timestamp_ntz, v double").withColumn("k", F.lit(1))
    total = timeline.running_total(df, ["k"], "at", "v", "t", ["id"], scale=3)
    assert total.agg(F.max("t")).first()[0] == 4.0
    with pytest.raises(PySparkException, match="more than 2 decimals"):
        timeline.running_total(df, ["k"], "at", "v", "t", ["id"]).collect()


def test_cube_over_number_and_date(spark):
    df = spark.createDataFrame([(1, date(2025, 1, 1), 2), (1, None, 3)], "a int, d date, v int")
    got = grouping.multi_grain(df, ["a", "d"], {"v": F.sum("v")}).select("a", "d", "v")
    want = [("1", "2025-01-01", 2), ("1", None, 3), ("1", "ALL", 5), ("ALL", "2025-01-01", 2), ("ALL", None, 3), ("ALL", "ALL", 5)]
    assert rows(got) == rows(spark.createDataFrame(want, "a string, d string, v bigint"))


def test_salted_outer_joins_are_refused(spark):
    one = spark.range(3).withColumnRenamed("id", "k")
    for how in ("right", "full_outer"):
        with pytest.raises(ValueError, match="repeated"):
            skew.salted_join(one, one, "k", "k", 4, how=how)


def test_promotion_replaces_on_success_only(spark):
    path = shared_dir(spark, "target")
    good = quality.Gates(totals={"rows": (F.count(F.lit(1)), 3)})
    assert quality.publish(spark.range(3), good, to=path).count() == 3
    with pytest.raises(quality.GateError):
        quality.publish(spark.range(2), good, to=path)
    assert spark.read.parquet(path).count() == 3
    df, ask = quality.counted(spark.range(7), {"rows": F.count(F.lit(1))})
    out = quality.publish(df, quality.Gates(totals={"rows": (F.count(F.lit(1)), lambda: ask("rows"))}))
    assert out.count() == 7
