"""Whole-table clean-up of text columns."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions.names import named, own_name
from ..functions.text import null_if_sentinel

ColumnRule = Callable[[Column], Column]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


def _rewrite_strings(df: DataFrame, rule: ColumnRule) -> DataFrame:
    text = set(string_columns(df))
    return df.select(
        *(rule(named(c)).alias(c) if c in text else named(c) for c in df.columns)
    )


def trim_strings(df: DataFrame, characters: str | None = None) -> DataFrame:
    """Trim every string column; spaces only, or the given characters."""
    if characters is None:
        return _rewrite_strings(df, F.trim)
    return _rewrite_strings(df, lambda c: F.btrim(c, F.lit(characters)))


def nullify_sentinels(df: DataFrame) -> DataFrame:
    """NULL for every text that only says that there is no value."""
    return _rewrite_strings(df, null_if_sentinel)


def _own_or_new(df: DataFrame, name: str) -> str:
    try:
        return own_name(df, name)
    except ValueError:
        return name


def normalize(
    df: DataFrame,
    columns: Mapping[str, ColumnRule] | None = None,
    derived: Mapping[str, tuple[str, ColumnRule]] | None = None,
) -> DataFrame:
    """Trim and null-out all text, then rewrite the named columns.

    ``columns`` maps a column to the rule that replaces it. ``derived`` maps a new
    (or replaced) column to the column it is computed from, as it was before
    ``columns`` applied, and its rule. Other columns pass through. Names are found as the
    session finds them, in any letter case unless ``spark.sql.caseSensitive`` is set, and
    keep the spelling of the table; a name that is absent raises.
    """
    columns = {own_name(df, name): rule for name, rule in (columns or {}).items()}
    derived = {
        _own_or_new(df, name): (own_name(df, source), rule) for name, (source, rule) in (derived or {}).items()
    }
    df = _rewrite_strings(df, lambda c: null_if_sentinel(F.trim(c)))

    def value(name: str) -> Column:
        if name in derived:
            source, rule = derived[name]
            return rule(named(source)).alias(name)
        return columns[name](named(name)).alias(name) if name in columns else named(name)

    added = [name for name in derived if name not in df.columns]
    return df.select(*(value(name) for name in [*df.columns, *added]))
