"""Duplicate keys: keep the first row of each key, reject the rest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import fixed_values as fixed
from ..functions.names import named
from ..sources.staging import StagingArea
from .decisions import PART, ROW
from .positions import place_of
from .rules import untagged
from .split import POSITION, REASON, accepted


def _winners(
    candidates: DataFrame, keys: Sequence[str], order_by: Sequence[str], area: StagingArea
) -> DataFrame:
    """The position of the row to keep, for each key that occurs more than once.

    One aggregation of the key, order and position columns. It combines before the shuffle,
    so a key that holds a large part of the table sends one row per task.
    """
    first = F.min(POSITION)
    if order_by:
        first = F.min(F.struct(*map(named, order_by), F.col(POSITION))).getField(POSITION)
    return area.stage(
        candidates.groupBy(*(named(k).alias(f"_key_{i}") for i, k in enumerate(keys)))
        .agg(F.count(F.lit(1)).alias("_copies"), first.alias("_keep"))
        .where(F.col("_copies") > 1)
        .drop("_copies"),
        "winners",
    )


def tag_duplicates(
    df: DataFrame,
    keys: str | Sequence[str],
    order_by: Sequence[str] = (),
    reason: str = fixed.DUPLICATE_KEY,
    area: StagingArea | None = None,
) -> DataFrame:
    """Reject all but the first row of each key.

    "First" is by ``order_by`` (NULLs first), and by file and place in it among equal rows or
    without ``order_by``. Rows rejected before are not looked at. The wide rows are not
    shuffled unless the table of repeated keys is too large to broadcast.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    area = StagingArea.for_frame(df, area)
    df = df if REASON in df.columns else untagged(df)
    if POSITION not in df.columns:
        place, is_fixed = place_of(df)
        df = df.withColumn(POSITION, place)
        df = df if is_fixed else area.stage(df, "rows")
    winners = _winners(df.where(accepted()), keys, order_by, area)
    same_key = [named(k).eqNullSafe(F.col(f"_key_{i}")) for i, k in enumerate(keys)]
    loses = accepted() & (F.col("_keep") != F.col(POSITION))
    return (
        df.join(winners, same_key, "left")
        .withColumn(REASON, F.when(loses, F.lit(reason)).otherwise(F.col(REASON)))
        .select(*map(named, df.columns))
    )


def later_copies(rows: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """``PART`` and ``ROW`` of all staged rows but the first of each key, as ``tag_duplicates`` finds them.

    The first row of a key in each part is found where the rows lie. Only the first ones of the parts
    meet, by one shuffle, so a key that holds a large part of the table sends one row per part. The other
    rows pass it without their values, dealt by their numbers.
    """
    key, order = [f"_key_{i}" for i in range(len(keys))], [f"_by_{i}" for i in range(len(order_by) + 1)]
    values = dict(zip(key + order, [*map(named, [*keys, *order_by]), F.col(POSITION)]))
    narrow = rows.where(accepted()).select(*(c.alias(name) for name, c in values.items()), PART, ROW)
    # Keys come first, as most rows differ in them: sorts then hardly have to compare anything else.
    here = F.row_number().over(Window.partitionBy(*key, PART).orderBy(*order))
    lost = narrow.withColumn("_lost", F.when(here > 1, F.col(ROW)))
    lost = lost.withColumns({name: F.when(F.col("_lost").isNull(), F.col(name)) for name in values})
    of_all = F.row_number().over(Window.partitionBy(*key, "_lost").orderBy(*order))
    return lost.withColumn("_nth", of_all).where(F.col("_lost").isNotNull() | (F.col("_nth") > 1)).select(PART, ROW)
