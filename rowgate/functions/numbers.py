"""Numbers out of text, limits and units."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed_values as fixed


def to_double(c: Column) -> Column:
    """Number, or NULL where the text is none."""
    return c.try_cast("double")


def finite_or_null(c: Column) -> Column:
    """Number for statistics: NaN and infinite values count as missing."""
    number = to_double(c)
    return F.when(F.abs(number) < float("inf"), number)


def is_infinite(c: Column) -> Column:
    """Whether the number is above or below all others; false for NULL and NaN."""
    number = F.abs(to_double(c))
    return F.coalesce((number == float("inf")) & ~F.isnan(number), F.lit(False))


def money(c: Column, signed: bool = False) -> Column:
    """Amount from text with currency signs and separators.

    The plain form keeps digits and points only, so a sign is lost;
    ``signed=True`` reads a leading minus or enclosing parentheses as negative.
    """
    amount = F.regexp_replace(c, fixed.NOT_MONEY, "").try_cast("double")
    if not signed:
        return amount
    return F.when(c.rlike(r"^[^\d]*-|^\s*\(.*\)\s*$"), -amount).otherwise(amount)


def over_limit(c: Column, high: float) -> Column:
    """Whether a number is above its limit; NULL counts as not above."""
    return F.coalesce(c > high, F.lit(False))


def clamp(c: Column, low: float, high: float) -> Column:
    """Number forced into ``[low, high]``; NULL stays NULL."""
    return F.when(c > high, F.lit(high)).when(c < low, F.lit(low)).otherwise(c)


def fahrenheit_to_celsius(c: Column, above: float = fixed.FAHRENHEIT_ABOVE) -> Column:
    """Celsius; a reading above ``above`` is taken for Fahrenheit."""
    return F.when(c > above, F.round((c - 32) * 5.0 / 9.0, 2)).otherwise(c)
