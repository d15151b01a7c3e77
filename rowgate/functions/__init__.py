"""Column expressions: each takes a Column and returns a Column."""

from .dates import age_in_years, date_text, parse_date, parse_timestamp
from .numbers import clamp, fahrenheit_to_celsius, finite_or_null, money, over_limit, to_double
from .text import (
    affirmative,
    category_or_default,
    category_or_upper,
    flag,
    flag_text,
    has_operator_prefix,
    mask_id,
    null_if_sentinel,
    percent_text,
    strip_operator_prefix,
    strip_trailing_punctuation,
    title_case,
)

__all__ = [
    "affirmative",
    "age_in_years",
    "category_or_default",
    "category_or_upper",
    "clamp",
    "date_text",
    "fahrenheit_to_celsius",
    "finite_or_null",
    "flag",
    "flag_text",
    "has_operator_prefix",
    "mask_id",
    "money",
    "null_if_sentinel",
    "over_limit",
    "parse_date",
    "parse_timestamp",
    "percent_text",
    "strip_operator_prefix",
    "strip_trailing_punctuation",
    "title_case",
    "to_double",
]
