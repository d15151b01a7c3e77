"""Helpers that the operators of this package share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

WHITE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or a longer one if the table has a column of that name."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def column(name: str) -> Column:
    """The column of exactly this name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def encoded(texts: pa.Array) -> Iterator[bytes]:
    """The UTF-8 bytes of each text; a null counts as empty."""
    for value in texts.cast(pa.large_binary()):
        yield value.as_py() or b""
    give_back()


def tune_for_texts(spark: SparkSession) -> None:
    """Send texts to workers in batches of few rows: texts are long, and a batch is in memory twice."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def give_back() -> None:
    """Hand memory that Arrow holds for later back to the system: the worker lives on, other tasks need it."""
    pa.default_memory_pool().release_unused()


def parts_for(spark: SparkSession, rows: int, per_part: int) -> int:
    """How many partitions of about ``per_part`` rows, one per core at least."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // per_part))


def running_blocks(df: DataFrame, block: str, order: str, sums: dict[str, str], by: Sequence[str] = ()) -> DataFrame:
    """Running sums over the blocks of a table that has one row per block and ``by`` group.

    ``sums`` maps a new column to the column whose values of all earlier blocks it adds up.
    The table has one row per partition of a larger one, not per row.
    """
    before = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return df.select(
        block, *by, *(F.coalesce(F.sum(c).over(before), F.lit(0)).alias(n) for n, c in sums.items())
    )


def flush_sorted(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """The rows of each run of equal keys as one table; the input is sorted by the key."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(batch.schema.get_field_index(key))
        ends = pa.compute.run_end_encode(keys).run_ends.to_pylist()
        starts = [0, *ends[:-1]]
        for start, end in zip(starts, ends):
            piece = batch.slice(start, end - start)
            if held and held[-1].column(key)[0].as_py() != piece.column(key)[0].as_py():
                yield pa.Table.from_batches(held)
                held = []
            held.append(piece)
        give_back()
    if held:
        yield pa.Table.from_batches(held)
