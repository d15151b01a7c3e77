"""Least and greatest values of Parquet columns, answered by the footers of their files."""

from __future__ import annotations

import math
from collections.abc import Sequence
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DoubleType, FloatType, IntegerType, LongType, ShortType

from ..functions.names import named, own_name
from ..session import settings

_NUMBERS = (ByteType, DoubleType, FloatType, IntegerType, LongType, ShortType)
#: The reader that can push aggregates down to footers, in a session of its own: others keep theirs.
_READER = {"spark.sql.sources.useV1SourceList": "avro,csv,json,kafka,orc,text"}
#: That it does so; it also asks the session that is active in the thread.
_PUSHED = {"spark.sql.parquet.aggregatePushdown": "true"}


def has_statistics(df: DataFrame) -> bool:
    """Whether this is a whole Parquet table, as ``spark.read.parquet`` or ``read_bucketed`` gives it."""
    plan = _relation(df)
    return plan.getClass().getSimpleName() == "LogicalRelation" and "row_index" in _hidden_fields(plan)


def _relation(df: DataFrame):
    plan = df._jdf.queryExecution().analyzed()
    while plan.getClass().getSimpleName() == "SubqueryAlias":
        plan = plan.child()
    return plan


def pushed_ranges(df: DataFrame, columns: Sequence[str]) -> DataFrame | None:
    """One row of ``low_i``, ``high_i`` for each column, from file statistics; None if ``df`` has none.

    Only a table as ``spark.read.parquet`` gives it has statistics of all its rows and no
    others, and only number columns have exact ones.
    """
    if not has_statistics(df):
        return None
    names = [own_name(df, c) for c in columns]
    if not names or not all(isinstance(df.schema[n].dataType, _NUMBERS) for n in names):
        return None
    files = [unquote(f) for f in df.inputFiles()]  # they are URIs
    if not files:
        return None
    session = df.sparkSession.newSession()
    for name, value in (_READER | _PUSHED).items():
        session.conf.set(name, value)
    with settings(df.sparkSession, _PUSHED):
        ranges = session.read.schema(df.schema).parquet(*files).agg(
            *(F.min(named(n)).alias(f"low_{i}") for i, n in enumerate(names)),
            *(F.max(named(n)).alias(f"high_{i}") for i, n in enumerate(names)),
        )
        ranges._jdf.queryExecution().executedPlan()  # planned here, while it is asked for
    return ranges


def _hidden_fields(plan) -> list[str]:
    hidden = plan.metadataOutput()
    return [
        name for i in range(hidden.size()) if hidden.apply(i).name() == "_metadata"
        for name in hidden.apply(i).dataType().fieldNames()
    ]


def footer_ranges(df: DataFrame, columns: Sequence[str]) -> list[tuple[float, float]] | None:
    """Least and greatest value of each column without reading a row, or None.

    None where a file has no statistics, as for a column with NaN or without any value, and
    where a value is infinite: then the rows have to tell what the finite values are.
    """
    pushed = pushed_ranges(df, columns)
    if pushed is None or "PushedAggregation: [MIN" not in pushed._jdf.queryExecution().executedPlan().toString():
        return None
    try:
        (row,) = pushed.collect()
    except (PySparkException, Py4JJavaError):  # a footer without statistics fails the small job that reads it
        return None
    # Footers write zeros signed.
    found = [(row[f"low_{i}"], row[f"high_{i}"]) for i in range(len(columns))]
    if any(v is None or not math.isfinite(v) for pair in found for v in pair):
        return None
    return [(float(low) + 0.0, float(high) + 0.0) for low, high in found]
