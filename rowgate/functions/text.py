"""String clean-up, categories and flags."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed_values as fixed


def null_if_sentinel(c: Column, sentinels: Iterable[str] = fixed.SENTINELS) -> Column:
    """NULL where the text only says that there is no value."""
    sentinels = tuple(sentinels)
    said = F.lower(c).isin(*sentinels)
    # Of all other characters only the Kelvin sign has an ASCII one, k, as its lower case: without it, a value of
    # another length than all of the sentinels need not be rewritten to tell.
    if sentinels and all(s.isascii() and "k" not in s for s in sentinels):
        said = F.octet_length(c).isin(*sorted({len(s) for s in sentinels})) & said
    return F.when(~said, c)


def _lookup(c: Column, mapping: Mapping[str, str | bool]) -> Column:
    entries = F.create_map(*(F.lit(x) for x in chain.from_iterable(mapping.items())))
    return F.try_element_at(entries, F.lower(c))


def category_or_default(c: Column, mapping: Mapping[str, str], default: str) -> Column:
    """Canonical category; other text becomes ``default``, NULL stays NULL."""
    return F.when(c.isNotNull(), F.coalesce(_lookup(c, mapping), F.lit(default)))


def category_or_upper(c: Column, mapping: Mapping[str, str]) -> Column:
    """Canonical category; other text is upper-cased."""
    return F.coalesce(_lookup(c, mapping), F.upper(c))


def flag(c: Column) -> Column:
    """True or false from its many spellings, NULL for anything else."""
    return _lookup(c, dict.fromkeys(fixed.TRUE_WORDS, True) | dict.fromkeys(fixed.FALSE_WORDS, False))


def affirmative(c: Column) -> Column:
    """True for an affirmative word, false for any other text, NULL for NULL."""
    return F.lower(c).isin(*fixed.AFFIRMATIVE_WORDS)


def flag_text(c: Column) -> Column:
    """A boolean written as ``True`` / ``False``."""
    # An expression named twice would be worked out twice.
    return F.try_element_at(F.create_map(F.lit(True), F.lit("True"), F.lit(False), F.lit("False")), c)


def has_operator_prefix(c: Column) -> Column:
    """Whether a reading starts with a comparison sign; never NULL."""
    return F.coalesce(c.rlike(fixed.OPERATOR_PREFIX), F.lit(False))


def strip_operator_prefix(c: Column) -> Column:
    return F.regexp_replace(c, fixed.OPERATOR_PREFIX_RUN, "")


def strip_trailing_punctuation(c: Column) -> Column:
    return F.regexp_replace(c, fixed.TRAILING_PUNCTUATION, "")


def title_case(c: Column) -> Column:
    return F.initcap(F.lower(c))


def mask_id(c: Column) -> Column:
    """First four characters of an id, the rest hidden; a missing id reads ``None***``."""
    return F.concat(F.substring(F.coalesce(c.cast("string"), F.lit("None")), 1, 4), F.lit("***"))


def percent_text(part: Column, whole: Column) -> Column:
    """Share with one decimal and a percent sign, ``N/A`` of nothing.

    ``format_number`` rounds the exact binary value half to even.
    """
    share = F.try_divide(part.cast("double"), whole.cast("double")) * 100
    return F.coalesce(F.concat(F.format_number(share, 1), F.lit("%")), F.lit("N/A"))
