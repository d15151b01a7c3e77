"""Equal-width histograms."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fixed
from ..functions.names import named
from ..functions.numbers import finite_or_null
from .footers import footer_ranges


@dataclass(frozen=True)
class Axis:
    """One charted column and the hard limits marked on its chart."""

    table: str
    column: str
    limit_low: float | None = None
    limit_high: float | None = None


def _edges(low: float, high: float, bins: int) -> tuple[float, float, float]:
    """First edge, last edge and bin width; a constant column gets a range of one."""
    if low == high:
        low, high = low - 0.5, high + 0.5
    return low, high, (high - low) / bins


def _bin(value: Column, low: float, high: float, width: float, bins: int) -> Column:
    """Bin number. Bins are closed below, the last one on both sides.

    The division may land one bin off next to an edge, so it is compared with the edges.
    """
    guess = F.least(F.floor((value - low) / (high - low) * bins), F.lit(bins - 1))
    below = value < guess * F.lit(width) + F.lit(low)
    above = (guess < bins - 1) & (value >= (guess + 1) * F.lit(width) + F.lit(low))
    return (guess - below.cast("int") + above.cast("int")).cast("int")


def histograms(
    tables: Mapping[str, DataFrame], axes: list[Axis], bins: int = fixed.HISTOGRAM_BINS
) -> DataFrame:
    """Counts per bin of every axis, empty bins included.

    One pass for the counts of each table; at most ``bins`` rows per column leave a task. The
    ranges come from the footers of Parquet files, or from a pass of their own where these do not
    have them. NULL, NaN and infinite values are left out.
    """
    parts = []
    for table in dict.fromkeys(axis.table for axis in axes):
        parts += _table_histograms(tables[table], [a for a in axes if a.table == table], bins)
    return reduce(DataFrame.unionByName, parts)


def _scanned_ranges(df: DataFrame, values: list[Column]) -> list[tuple[float | None, float | None]]:
    row = df.agg(
        *(F.min(v).alias(f"low_{i}") for i, v in enumerate(values)),
        *(F.max(v).alias(f"high_{i}") for i, v in enumerate(values)),
    ).first()
    return [(row[f"low_{i}"], row[f"high_{i}"]) for i in range(len(values))]


def _table_histograms(df: DataFrame, axes: list[Axis], bins: int) -> list[DataFrame]:
    values = [finite_or_null(named(a.column)) for a in axes]
    known = footer_ranges(df, [a.column for a in axes])
    ranges = known or _scanned_ranges(df, values)
    placed, charts = [], []
    for i, axis in enumerate(axes):
        low, high = ranges[i]
        if low is None:
            continue
        low, high, width = _edges(low, high, bins)
        name = F.lit(axis.column).alias("column")
        placed.append(F.struct(name, _bin(values[i], low, high, width, bins).alias("bin")))
        charts.append(
            F.struct(
                name,
                F.lit(low).alias("first"),
                F.lit(high).alias("last"),
                F.lit(width).alias("width"),
                F.lit(axis.limit_low).cast("double").alias("limit_low"),
                F.lit(axis.limit_high).cast("double").alias("limit_high"),
            )
        )
    if not placed:
        return []
    counted = (
        df.select(F.inline(F.array(*placed)))
        .where(F.col("bin").isNotNull())
        .groupBy("column", "bin")
        .agg(F.count(F.lit(1)).alias("row_count"))
    )
    every_bin = (
        df.sparkSession.range(0, 1, 1, 1)
        .select(F.inline(F.array(*charts)))
        .withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    )
    start = F.col("first") + F.col("bin") * F.col("width")
    end = F.col("first") + (F.col("bin") + 1) * F.col("width")
    return [
        every_bin.join(counted, ["column", "bin"], "left").select(
            F.lit(axes[0].table).alias("table"),
            "column",
            "bin",
            start.alias("low"),
            F.when(F.col("bin") == bins - 1, F.col("last")).otherwise(end).alias("high"),
            F.coalesce("row_count", F.lit(0)).alias("row_count"),
            "limit_low",
            "limit_high",
        )
    ]
