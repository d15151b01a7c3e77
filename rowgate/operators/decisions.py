"""Rows that stay where they were written, and the reasons that rules find for them later.

Wide rows are written once, and no rule moves them again. A rule's join carries the columns it
needs and the number of each row, and leaves the numbers and reasons of the rows that it rejects.
The rows are bucketed by a part that the task that wrote them chose, so the short list of reasons
comes to the rows and not the other way round.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import cache, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import named
from ..sources.buckets import read_bucketed, write_as_dealt
from ..sources.staging import StagingArea, file_system
from .split import REASON, accepted

#: The part that a row was dealt into, and the row's number, which no other row has.
PART, ROW = "_part", "_row"
#: A task deals its rows into so many parts, in blocks of so many rows (a power of 2).
PARTS_PER_TASK, BLOCK_BITS = 8, 14
#: A number holds the task above these bits.
TASK_BITS = 33
_WORD = 0xFFFFFFFF


def _hash(number: int) -> int:
    """Spark's hash of an int, without its sign: Murmur3 of one block with seed 42."""

    def turned(x: int, bits: int) -> int:
        return (x << bits | x >> 32 - bits) & _WORD

    h = 42 ^ turned(number * 0xCC9E2D51 & _WORD, 15) * 0x1B873593 & _WORD
    h = (turned(h, 13) * 5 + 0xE6546B64 & _WORD) ^ 4
    h = (h ^ h >> 16) * 0x85EBCA6B & _WORD
    h = (h ^ h >> 13) * 0xC2B2AE35 & _WORD
    return h ^ h >> 16


@cache
def _parts(buckets: int) -> list[int]:
    """A number for each bucket, so that rows dealt over the numbers fill the buckets evenly.

    A row's bucket follows from the hash of its number; no job is needed to know it.
    """
    found: dict[int, int] = {}
    for number in range(20 * buckets + 100):
        h = _hash(number)
        found.setdefault((h - (h >> 31 << 32)) % buckets, number)
    return sorted(found.values())


def _numbered(df: DataFrame, buckets: int) -> DataFrame:
    """The rows with ``ROW`` and ``PART``."""
    # The ids of a row are the same wherever they stand in one projection; one more would copy all rows again.
    row, parts = F.monotonically_increasing_id(), _parts(buckets)
    block = F.shiftright(row, BLOCK_BITS) % PARTS_PER_TASK
    place = (F.shiftright(row, TASK_BITS) * PARTS_PER_TASK + block) % len(parts)
    part = F.element_at(F.array(*map(F.lit, parts)), (place + 1).cast("int"))
    return df.select("*", row.alias(ROW), part.alias(PART))


def stage_rows(df: DataFrame, name: str, area: StagingArea) -> DataFrame:
    """Write ``df`` once, without a shuffle, and return the written rows with ``PART`` and ``ROW``."""
    spark = df.sparkSession
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)
    # Under plain names: a catalog need not take those of the table.
    plain = df.toDF(*(f"c{i}" for i in range(len(df.columns))))
    numbered = _numbered(plain, buckets)
    path = f"{area.path}/{name}-{uuid.uuid4().hex[:8]}"
    write_as_dealt(numbered, path, PART, buckets)
    staged = read_bucketed(spark, path, numbered.schema, PART, buckets)
    return staged.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(df.columns)), PART, ROW)


def stage_reasons(tagged: DataFrame, area: StagingArea) -> DataFrame:
    """Write the numbers and reasons of the rejected rows."""
    return area.stage(tagged.where(~accepted()).select(PART, ROW, REASON), "reasons")


def with_reasons(rows: DataFrame, found: Sequence[DataFrame]) -> DataFrame:
    """The staged rows with the reasons found for them; a row is in one of the lists at most."""
    if not found:
        return rows
    reasons = reduce(DataFrame.unionAll, found).withColumnRenamed(REASON, "_found")
    # A short list comes to all rows, which find a number alone faster than a number and a part.
    short = _is_short(found)
    reasons = reasons.drop(PART) if short else reasons.hint("shuffle_hash")
    return (
        rows.join(reasons, [ROW] if short else [PART, ROW], "left")
        .withColumn(REASON, F.coalesce(F.col(REASON), F.col("_found")))
        .select(*map(named, rows.columns))
    )


def to_the_rows(df: DataFrame, staged: Sequence[DataFrame]) -> DataFrame:
    """``df``, made of staged tables, to be joined to staged rows by ``PART`` and other columns."""
    # Rows that lie as they are dealt need no sort to meet a table.
    return df if _is_short(staged) else df.hint("shuffle_hash")


def _is_short(found: Sequence[DataFrame]) -> bool:
    """Whether Spark would broadcast these tables."""
    spark = found[0].sparkSession
    most = int(spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())
    size = 0
    for df in found:
        for file in df.inputFiles():
            fs, path = file_system(spark, file)
            size += fs.getFileStatus(path).getLen()
    return size <= most
