"""Where the bound queries register themselves."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import pin_session
from ..sources.tables import given

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
TWINS: dict[str, str] = {}


class Given:
    """The given tables of one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return given(self.spark, self.folder, name)


def query(name: str, twin: str | None = None):
    """Register ``fn(given)`` under a name, with the SQL that has to give the same rows."""

    def add(fn: Callable[[Given], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = lambda spark, folder: fn(Given(pin_session(spark), folder))
        if twin:
            TWINS[name] = twin
        return fn

    return add
