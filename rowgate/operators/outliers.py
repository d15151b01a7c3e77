"""Z-score outliers."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fixed
from ..functions.names import named
from ..functions.numbers import finite_or_null, is_infinite
from ..sources.staging import StagingArea
from .rules import untagged
from .split import REASON, accepted

Moments = dict[str, tuple[float | None, float | None]]


def moments(df: DataFrame, columns: Iterable[str]) -> Moments:
    """Mean and sample standard deviation of each column, in one pass.

    One row of 2 numbers per column comes back to the driver, and the numbers enter
    the plans as literals: two uses then agree to the last bit on every row, which two
    evaluations of a distributed sum would not.
    """
    columns = list(columns)
    aggregates = []
    for i, name in enumerate(columns):
        value = finite_or_null(named(name))
        aggregates += [F.avg(value).alias(f"mean_{i}"), F.stddev_samp(value).alias(f"sd_{i}")]
    row = df.agg(*aggregates).first() if columns else None
    return {name: (row[f"mean_{i}"], row[f"sd_{i}"]) for i, name in enumerate(columns)}


def is_outlier(name: str, stats: Moments, threshold: float = fixed.Z_THRESHOLD) -> Column:
    """Whether |z| is above the threshold; false for NULL, NaN and where nothing varies.

    An infinite value is an outlier whatever the others are, and takes no part in their mean.
    """
    mean, sd = stats[name]
    if not sd:
        return is_infinite(named(name))
    z = (finite_or_null(named(name)) - F.lit(mean)) / F.lit(sd)
    return is_infinite(named(name)) | F.coalesce(F.abs(z) > F.lit(threshold), F.lit(False))


def outlier_reason(column: str) -> str:
    return f"zscore_outlier_{column}"


def tag_outliers(
    df: DataFrame,
    columns: str | Sequence[str],
    threshold: float = fixed.Z_THRESHOLD,
    sequential: bool = True,
    area: StagingArea | None = None,
) -> DataFrame:
    """Reject rows with an outlying value in any of the columns.

    ``sequential`` judges each column by the rows that the columns before it left, one
    aggregation per column; otherwise all columns are judged by the same rows at once.
    Rows rejected before do not count. No join and no shuffle of rows.
    """
    columns = [columns] if isinstance(columns, str) else list(columns)
    df = df if REASON in df.columns else untagged(df)
    survivors = df.where(accepted()).select(*map(named, columns))
    if sequential and len(columns) > 1:
        # Several passes: read the few columns from a written table each time.
        survivors = StagingArea.for_frame(df, area).stage(survivors, "measures")
        stats: Moments = {}
        for name in columns:
            stats |= moments(survivors, [name])
            survivors = survivors.where(~is_outlier(name, stats, threshold))
    else:
        stats = moments(survivors, columns)
    reasons = [
        F.when(is_outlier(c, stats, threshold), F.lit(outlier_reason(c))) for c in columns
    ]
    return df.withColumn(REASON, F.coalesce(F.col(REASON), *reasons))
