"""Foreign keys: rows whose parent is missing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.names import named
from ..sources.staging import StagingArea
from .decisions import PART, ROW, to_the_rows
from .rules import untagged
from .split import REASON, accepted


def orphan_keys(child: DataFrame, column: str, parents: DataFrame, parent_key: str) -> DataFrame:
    """Distinct non-null values of ``column`` without a parent, as ``_orphan``.

    The child is reduced to its distinct keys before it meets the parents, so neither a
    hot key nor the child's other columns are shuffled.
    """
    used = child.where(named(column).isNotNull()).select(named(column).alias("_orphan")).distinct()
    known = parents.select(named(parent_key).alias("_known"))
    return used.join(known, F.col("_orphan") == F.col("_known"), "left_anti")


def tag_orphans(
    df: DataFrame,
    column: str,
    parents: DataFrame,
    reason: str,
    parent_key: str | None = None,
    area: StagingArea | None = None,
) -> DataFrame:
    """Reject rows whose ``column`` is NULL or has no row in ``parents``.

    The missing keys are found first on the key column alone and written; the wide rows
    then join that usually short list, which is broadcast while it is small.
    """
    area = StagingArea.for_frame(df, area)
    df = df if REASON in df.columns else untagged(df)
    orphans = orphan_keys(df.where(accepted()), column, parents, parent_key or column)
    orphans = area.stage(orphans, "orphan-keys")
    missing = named(column).isNull() | F.col("_orphan").isNotNull()
    return (
        df.join(orphans, named(column) == F.col("_orphan"), "left")
        .withColumn(REASON, F.when(accepted() & missing, F.lit(reason)).otherwise(F.col(REASON)))
        .select(*map(named, df.columns))
    )


def orphan_rows(
    rows: DataFrame,
    column: str,
    parents: DataFrame,
    parent_key: str | None = None,
    area: StagingArea | None = None,
    staged: DataFrame | None = None,
) -> DataFrame:
    """``PART`` and ``ROW`` of the staged rows that ``tag_orphans`` rejects.

    The distinct keys of each part meet the parents, and the missing ones come back to their part. So no
    row is shuffled, however long the list of missing keys is, and a hot key sends one row per part.
    ``staged`` are the rows as they were written, which may have less rows rejected: their keys are all keys of
    ``rows``, and are found without the reasons that other rules found.
    """
    area = StagingArea.for_frame(rows, area)
    used = rows.where(accepted()).select(PART, ROW, named(column).alias("_used"))
    written = (rows if staged is None else staged).where(accepted() & named(column).isNotNull())
    keys = written.select(PART, named(column).alias("_orphan")).distinct()
    known = parents.select(named(parent_key or column).alias("_known"))
    orphans = area.stage(keys.join(known, F.col("_orphan") == F.col("_known"), "left_anti"), "orphan-keys")
    orphans = to_the_rows(orphans, [orphans]).withColumnRenamed(PART, "_of")
    same = (F.col(PART) == F.col("_of")) & (F.col("_used") == F.col("_orphan"))
    missing = F.col("_used").isNull() | F.col("_orphan").isNotNull()
    return used.join(orphans, same, "left").where(missing).select(PART, ROW)
