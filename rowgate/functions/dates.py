"""Dates and timestamps written in many layouts.

The meaning is "try every layout in order, the first that parses wins". One call per
layout is slow, since a failed parse costs far more than a good one, and the generated
code outgrows the JIT. So the layouts are the optional sections of one pattern: the
parser skips a section that does not fit. A section never stands before a longer one
that starts alike.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed_values as fixed

DATE_PATTERN = (
    "[yyyy-MM-dd][yyyy/MM/dd][M/d/yyyy][M/d/yy][d-M-yyyy][MMMM d, yyyy][MMM d, yyyy]"
)
TIMESTAMP_PATTERN = (
    "[yyyy-MM-dd'T'HH:mm:ss.SSSSSS][yyyy-MM-dd'T'HH:mm:ss][yyyy-MM-dd HH:mm:ss][yyyy-MM-dd]"
    "[yyyy/MM/dd]"
    "[dd-MM-yyyy HH:mm:ss][dd-MM-yyyy HH:mm][dd-MM-yyyy]"
    "[M/d/yyyy H:mm:ss][M/d/yyyy H:mm]"
    "[M/d/yy h:mm a][MM/dd/yy HH:mm][M/d/yy]"
)

# One date, be its year signed: two separators, or one comma after a month. The sections of a
# pattern would also take two dates without anything in between. After a short month name a
# day has two digits at most and a year no sign.
_SHORT_MONTH = "(?i:jan|feb|mar|apr|jun|jul|aug|sep|oct|nov|dec)"
ONE_DATE = rf"^(?!{_SHORT_MONTH} (?:\d{{3}}|.*-))(?:[+-]?[^-/,]*[-/][^-/,]*[-/][^-/,]*|[^-/,]*, ?-?[^-/,]*)\z"
ONE_TIMESTAMP = r"^[+-]?[^-/]*[-/][^-/]*[-/][^-/]*\z"
# The shortest date has six characters, so any shorter than this is one date at most.
TWO_DATES = 12
ISO_DATE = r"^(?:\d{4}|-\d{4,6}|\+\d{5,6})-\d\d-\d\d\z"

# Every character that counts as space in a loosely written date.
_SPACE = r"[\s\x0b\x1c-\x1f\x85\p{Z}]"
ONE_LOOSE_DATE = (
    r"^(?:[^-/,]*[-/][^-/,]*[-/][^-/,]*"
    rf"|{_SPACE}*[A-Za-z]+{_SPACE}*\d{{1,2}}{_SPACE}*,{_SPACE}*\d+{_SPACE}*)\z"
)


# The usual layouts, rewritten so that a cast reads them, which takes a fraction of a pattern's time. Text of any
# other layout becomes signs that no cast reads. Only shapes are told here; whether there is such a day, the cast tells.
_NUMBERED = (
    r"^(?:([1-9]\d{3})([-/])(\d\d)\2(\d\d)|(\d\d?)/(\d\d?)/([1-9]\d{3})|(\d\d?)-(\d\d?)-([1-9]\d{3})|(?s:.*))\z",
    "$1$7$10-$3$5$9-$4$6$8",
)
_OF_2000 = (r"^(?:(\d\d?)/(\d\d?)/(\d\d)|(?s:.*))\z", "20$3-$1-$2")
_TIMED = (
    r"^(?:([1-9]\d{3})-(\d\d)-(\d\d)(?:T(\d\d:\d\d:\d\d(?:\.\d{6})?)| (\d\d:\d\d:\d\d))?|([1-9]\d{3})/(\d\d)/(\d\d)"
    r"|(\d\d)-(\d\d)-([1-9]\d{3})(?: (\d\d:\d\d(?::\d\d)?))?|(\d\d?)/(\d\d?)/([1-9]\d{3}) (\d\d?:\d\d(?::\d\d)?)|(?s:.*))\z",
    "$1$6$11$15-$2$7$10$13-$3$8$9$14 $4$5$12$16",
)
_TIMED_OF_2000 = (
    r"^(?:(\d\d)/(\d\d)/(\d\d) (\d\d:\d\d)|(\d\d?)/(\d\d?)/(\d\d)|(?s:.*))\z",
    "20$3$7-$1$5-$2$6 $4",
)
_MONTHS = ("January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November",
           "December")
_DAY_AFTER_MONTH = "^(?:" + "|".join(f"{m[:3]}(?:{m[3:]})?" for m in _MONTHS) + r") (\d\d?), [1-9]\d{3}\z"


def _usual_date(c: Column) -> Column:
    """Date from one of the usual layouts; NULL says nothing."""
    short = "".join(m[:3] for m in _MONTHS)
    month = ((F.instr(F.lit(short), F.substring(c, 1, 3)) + 2) / 3).cast("int").cast("string")
    named = F.concat(F.substring(c, -4, 4), F.lit("-"), month, F.lit("-"), F.regexp_extract(c, _DAY_AFTER_MONTH, 1))
    texts = F.regexp_replace(c, *_NUMBERED), F.regexp_replace(c, *_OF_2000), named
    return F.coalesce(*(text.try_cast("date") for text in texts))


def _usual_timestamp(c: Column) -> Column:
    """Timestamp from one of the usual layouts; NULL says nothing."""
    return F.coalesce(*(F.regexp_replace(c, *layout).try_cast("timestamp") for layout in (_TIMED, _TIMED_OF_2000)))


def _tidy(c: Column) -> Column:
    """Rewrite a loosely written date so that the pattern fits it.

    Takes out space around the text, after words and before a one-digit day, and pads
    the one-digit parts of year-first dates. In such text a two-digit year from 69 on means the last century.
    """
    c = F.regexp_replace(c, rf"^{_SPACE}+|{_SPACE}+\z", "")
    c = F.regexp_replace(c, rf"(?<=[A-Za-z,]){_SPACE}+", " ")
    c = F.regexp_replace(
        c, r"(?<=^\d{1,2}/) (?=[1-9]/(\d\d|\d{4})\z)|(?<=^\d{4}[-/]\d{1,2}[-/]) (?=[1-9]\z)", ""
    )
    c = F.regexp_replace(
        c, r"(?<=^\d{4}[-/])(?=[1-9][-/])|(?<=^\d{4}[-/]\d{1,2}[-/])(?=[1-9]\z)", "0"
    )
    c = F.regexp_replace(c, r"^(\d{1,2}/\d{1,2}/)(69|[7-9]\d)\z", "$119$2")
    return F.regexp_replace(c, r"^\z", "-")  # nothing left: not a date either


def _one(c: Column, shape: str) -> Column:
    """The text if it is too short for two dates or has the shape of one.

    A pattern of optional sections alone also accepts the empty string.
    """
    return F.when((c != "") & ((F.length(c) < TWO_DATES) | c.rlike(shape)), c)


def _any_date(c: Column) -> Column:
    return F.coalesce(
        F.try_to_date(_one(c, ONE_DATE), DATE_PATTERN),
        F.when(c.rlike(ONE_LOOSE_DATE), F.try_to_date(_tidy(c), DATE_PATTERN)),
    )


def parse_date(c: Column) -> Column:
    """Date from any known layout, NULL where none fits.

    Two-digit years are 20yy; a day that does not exist is NULL.
    """
    return F.coalesce(_usual_date(c), _any_date(c))


def parse_timestamp(c: Column) -> Column:
    """Timestamp from any known layout, NULL where none fits."""
    return F.coalesce(_usual_timestamp(c), F.try_to_timestamp(_one(c, ONE_TIMESTAMP), F.lit(TIMESTAMP_PATTERN)))


def iso_date(c: Column) -> Column:
    """A date as it is, and ``yyyy-MM-dd`` text as a date; any other text is NULL."""
    written = (F.typeof(c) != "string") | c.cast("string").rlike(ISO_DATE)
    return F.when(written, c.try_cast("date"))


def date_text(c: Column) -> Column:
    """Any known date layout rewritten as ``yyyy-MM-dd`` text."""
    # A usual date has a year of four digits, so its plain text is the same.
    return F.coalesce(_usual_date(c).cast("string"), F.date_format(_any_date(c), "yyyy-MM-dd"))


def age_in_years(born: Column, as_of: date, by_calendar: bool = False) -> Column:
    """Whole years from ``born`` to ``as_of``.

    The plain form divides days by 365.25 and is off by one around some birthdays;
    ``by_calendar=True`` counts calendar years.
    """
    if by_calendar:
        return F.floor(F.months_between(F.lit(as_of), born) / 12).cast("int")
    return F.floor(F.datediff(F.lit(as_of), born) / fixed.DAYS_PER_YEAR).cast("int")
