"""Tables bucketed by their key: joins and groupings by that key read them without a shuffle.

A row's bucket follows from its key, so only tables whose keys are unique are bucketed here: no
bucket is larger than others. Where a table is joined by a key of which another one holds very
many rows, ``read_parquet`` reads the same files as rows in any order, which Spark can split.

Buckets are known to a catalog only. So each table is entered for as long as it takes to write
it, or to plan a read, under a name of its own, and nothing is left there.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.names import named, own_name
from .staging import file_system


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


@contextmanager
def _entered(spark: SparkSession) -> Iterator[str]:
    name = f"rowgate_{uuid.uuid4().hex}"
    try:
        yield name
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def _absolute(spark: SparkSession, path: str) -> str:
    fs, folder = file_system(spark, path)
    return fs.makeQualified(folder).toString()


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int) -> None:
    """Write the table to a new path, one sorted file per bucket of ``key``, by one shuffle."""
    spark, key = df.sparkSession, own_name(df, key)
    with _entered(spark) as name:
        writer = df.repartition(buckets, named(key)).write.format("parquet").option("path", _absolute(spark, path))
        writer.bucketBy(buckets, key).sortBy(key).saveAsTable(name)


def _enter(spark: SparkSession, name: str, path: str, schema: StructType, dealt: str) -> None:
    place = _absolute(spark, path).replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} ({schema.toDDL()}) USING parquet {dealt} LOCATION '{place}'")


def write_as_dealt(df: DataFrame, path: str, column: str, buckets: int) -> None:
    """Write the table to a new path without a shuffle, bucketed by a column that has few values per task.

    Packed tighter than by default, as tables of all rows are most of what is written; and without dictionaries, which
    zstd makes needless and which cost more time than all else that the writer does. The table is entered first and filled
    then: ``saveAsTable`` runs the query out of sight of observations.
    """
    spark = df.sparkSession
    with _entered(spark) as name:
        dealt = f"CLUSTERED BY ({_quoted(column)}) INTO {buckets} BUCKETS"
        options = "OPTIONS (compression 'zstd', 'parquet.enable.dictionary' 'false')"
        _enter(spark, name, path, df.schema, f"{options} {dealt}")
        df.write.insertInto(name)


def read_bucketed(spark: SparkSession, path: str, schema: StructType, key: str, buckets: int) -> DataFrame:
    """A table that ``write_bucketed`` wrote; plans know how its rows are dealt."""
    with _entered(spark) as name:
        dealt = f"CLUSTERED BY ({_quoted(key)}) SORTED BY ({_quoted(key)}) INTO {buckets} BUCKETS"
        _enter(spark, name, path, schema, dealt)
        return spark.table(name)


def largest_share(df: DataFrame, key: str) -> float:
    """The share of the rows that the most frequent value of ``key``, NULL included, holds; 0 without rows."""
    counts = df.groupBy(named(key).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    row = counts.agg(F.max("n").alias("most"), F.sum("n").alias("rows")).first()
    return row["most"] / row["rows"] if row["rows"] else 0.0
