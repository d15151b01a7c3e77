"""Row rules: each looks at one row and names the reason to reject it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import iso_date
from ..functions.names import named
from .split import REASON


@dataclass(frozen=True)
class RowRule:
    """A condition that a row breaks, and the reason it is rejected for."""

    reason: str

    def broken(self) -> Column:
        raise NotImplementedError


@dataclass(frozen=True)
class Required(RowRule):
    """The column has a value; for a parsed column, its text could be parsed."""

    column: str = ""

    def broken(self) -> Column:
        return named(self.column).isNull()


@dataclass(frozen=True)
class NotAfter(RowRule):
    """The date, also as ISO text, is not after ``latest``; NULL passes."""

    column: str = ""
    latest: date = date.max

    def broken(self) -> Column:
        return iso_date(named(self.column)) > F.lit(self.latest)


@dataclass(frozen=True)
class Matches(RowRule):
    """The text matches the pattern; NULL passes."""

    column: str = ""
    pattern: str = ""

    def broken(self) -> Column:
        return ~named(self.column).rlike(self.pattern)


@dataclass(frozen=True)
class Within(RowRule):
    """Every column lies in its closed range; NULL passes."""

    ranges: Mapping[str, tuple[float, float]] | None = None

    def broken(self) -> Column:
        return reduce(or_, (outside(named(c), *bounds) for c, bounds in self.ranges.items()))


def outside(c: Column, low, high) -> Column:
    """Whether a value lies outside the closed range (either end may be open); never NULL."""
    sides = [c < F.lit(low)] if low is not None else []
    sides += [c > F.lit(high)] if high is not None else []
    return F.coalesce(reduce(or_, sides), F.lit(False)) if sides else F.lit(False)


def untagged(df: DataFrame) -> DataFrame:
    """The table with no row rejected yet."""
    return df.withColumn(REASON, F.lit(None).cast("string"))


def tag_rows(df: DataFrame, rules: Sequence[RowRule]) -> DataFrame:
    """Reject each row by the first rule it breaks; earlier reasons stand."""
    df = df if REASON in df.columns else untagged(df)
    reasons = [F.when(rule.broken(), F.lit(rule.reason)) for rule in rules]
    return df.withColumn(REASON, F.coalesce(F.col(REASON), *reasons))
