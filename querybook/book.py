"""Registry of queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[Tables], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The test tables of one folder, as attributes."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self._folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self._folder}/{name}.parquet")


def query(sql: str | None = None):
    """Register a query under its function name, with the SQL it is compared to."""

    def register(build: Callable[[Tables], DataFrame]):
        QUERIES[build.__name__] = build
        if sql is not None:
            ORACLES[build.__name__] = sql
        return build

    return register


def pick(key: str, *texts: str | None) -> Column:
    """One of the texts per row, by the row's key."""
    listed = ", ".join("NULL" if t is None else "'" + t.replace("'", "\\'") + "'" for t in texts)
    return F.expr(f"element_at(array({listed}), cast({key} % {len(texts)} as int) + 1)")
