"""Publish gates: every one is a full-table number compared with what it has to be."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..session import discard, materialise
from .fingerprint import Fingerprint, parts, same_multiset


# What rounding each group's total to a double may lose of a sum.
DOUBLE_NOISE = 1e-12


class GateError(RuntimeError):
    """The data broke a publish gate."""


@dataclass
class Gates:
    """``unique``      the grain: no two rows share it (NULL counts as a value)
    ``not_null``    columns that are always set
    ``violations``  name -> condition that no row may meet
    ``totals``      name -> (aggregate over the output, number it has to equal[, relative tolerance]); the
                    number may be a function, asked after the output was written (see ``counted``)
    ``ddl``         declared names, order and types of the output
    ``rerun_of``    fingerprint of an earlier run over the same input, which this one has to repeat
    """

    unique: Sequence[str] = ()
    not_null: Sequence[str] = ()
    violations: Mapping[str, Column] = field(default_factory=dict)
    totals: Mapping[str, tuple] = field(default_factory=dict)
    ddl: str | None = None
    rerun_of: Fingerprint | None = None


def schema_problems(df: DataFrame, ddl: str) -> list[str]:
    """Differences in names, order and types; nullability is not part of the contract."""
    want = [(f.name, f.dataType.simpleString()) for f in _parse(df, ddl)]
    have = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    return [] if want == have else [f"schema: declared {want}, got {have}"]


def _parse(df: DataFrame, ddl: str):
    return df.sparkSession.createDataFrame([], ddl).schema.fields


def problems(df: DataFrame, gates: Gates) -> list[str]:
    """What is wrong, from one aggregate over the whole table.  Empty input passes row gates."""
    found = schema_problems(df, gates.ddl) if gates.ddl else []
    aggs = [F.count(F.lit(1)).alias("rows")]
    if gates.unique:
        aggs.append(_grains(gates.unique).alias("grains"))
    for i, c in enumerate(gates.not_null):
        aggs.append(F.count_if(F.col(c).isNull()).alias(f"null_{i}"))
    for i, cond in enumerate(gates.violations.values()):
        aggs.append(F.count_if(cond).alias(f"bad_{i}"))
    for i, (total, *_) in enumerate(gates.totals.values()):
        aggs.append(F.coalesce(total, F.lit(0)).alias(f"total_{i}"))
    if gates.rerun_of:
        aggs.append(F.struct(*parts(df)).alias("mark"))
    if len(aggs) == 1:
        return found
    got = df.agg(*aggs).first()
    if gates.unique and got["grains"] != got["rows"]:
        found.append(f"unique {list(gates.unique)}: {got['rows']} rows, {got['grains']} grains")
    for i, c in enumerate(gates.not_null):
        if got[f"null_{i}"] != 0:
            found.append(f"not null {c}: {got[f'null_{i}']} rows")
    for i, name in enumerate(gates.violations):
        if got[f"bad_{i}"] != 0:
            found.append(f"{name}: {got[f'bad_{i}']} rows")
    for i, (name, (_, want, *slack)) in enumerate(gates.totals.items()):
        number = (want() if callable(want) else want) or 0
        if not _close(got[f"total_{i}"], number, *slack):
            found.append(f"{name}: expected {number}, got {got[f'total_{i}']}")
    if gates.rerun_of and gates.rerun_of != Fingerprint(tuple(df.dtypes), *got["mark"]):
        found.append(f"rerun: {gates.rerun_of.rows} rows before, {got['rows']} now, and not the same")
    return found


def _close(got, want, slack: float = 0.0) -> bool:
    return got == want or abs(float(got) - float(want)) <= slack * abs(float(want))


def _grains(keys: Sequence[str]) -> Column:
    """Distinct keys, NULL being one of the values."""
    if len(keys) > 1:
        return F.count_distinct(F.struct(*keys))
    (key,) = keys
    null = F.coalesce(F.max(F.when(F.col(key).isNull(), 1)), F.lit(0))
    return F.count_distinct(key) + null


def check(df: DataFrame, gates: Gates) -> DataFrame:
    found = problems(df, gates)
    if found:
        raise GateError("; ".join(found))
    return df


def publish(df: DataFrame, gates: Gates, label: str = "publish", to: str | None = None) -> DataFrame:
    """Write once, check what was written, hand out exactly that.

    The gates read the staged columns they need; the job itself never runs twice, and a source that
    moves meanwhile cannot make the checked rows differ from the published ones.

    With ``to`` the checked rows are promoted to that path, in place of what it held, and the stage is
    removed, on success as on failure.  Without it the stage is what is handed out.
    """
    staged = materialise(df, "table", label)
    if to is None:
        return check(staged, gates)
    try:
        check(staged, gates).write.mode("overwrite").parquet(to)
    finally:
        discard(staged)
    return df.sparkSession.read.schema(staged.schema).parquet(to)


def counted(df: DataFrame, aggs: Mapping[str, Column]):
    """``df``, and a function that gives its numbers as they were in the run that read it.

    Ask after an action over ``df`` is through.  Where that run had no need to read it at all, because nothing
    could come of it (an empty side of a join), the numbers are computed when asked for.  Any other failure is one.
    """
    seen, numbers = Observation(), [e.alias(name) for name, e in aggs.items()]

    def ask(name: str):
        try:
            return seen.get[name]
        except Py4JJavaError as e:
            if not _unseen(e):
                raise
            return df.agg(*numbers).first()[name]

    return df.observe(seen, *numbers), ask


def _unseen(e: Py4JJavaError) -> bool:
    """The run was through and had left the observed rows out."""
    return e.java_exception.getClass().getName() == "java.lang.AssertionError"


def measure(df: DataFrame, aggs: Mapping[str, Column]):
    """Several whole-table numbers in one pass, as one row."""
    return df.agg(*[e.alias(name) for name, e in aggs.items()]).first()


def row_count(df: DataFrame) -> int:
    """Rows at the raw input: the denominator of a conservation gate."""
    return df.agg(F.count(F.lit(1))).first()[0]


def same_rows(a: DataFrame, b: DataFrame) -> bool:
    """Both hold the same rows with the same multiplicity: the rerun gate, one aggregate per side."""
    return same_multiset(a, b)


def differing_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """What ``same_rows`` found: rows with how many more of them ``a`` holds than ``b``."""
    both = a.withColumn("_more", F.lit(1)).unionByName(b.withColumn("_more", F.lit(-1)))
    return both.groupBy(*a.columns).agg(F.sum("_more").alias("surplus")).filter("surplus <> 0")
