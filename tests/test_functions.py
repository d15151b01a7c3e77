"""Column functions on single values."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from rowgate import fixed_values as fixed
from rowgate import functions as fn
from rowgate.functions import dates


def apply(spark, rule, values, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")
    result = rows.select("i", rule(F.col("c")).alias("r")).orderBy("i").collect()
    return [row["r"] for row in result]


def check(spark, rule, expected, kind="string"):
    assert dict(zip(expected, apply(spark, rule, list(expected), kind))) == expected


def test_parse_date(spark):
    check(spark, fn.parse_date, {
        "2019-11-07": date(2019, 11, 7), "09/17/2022": date(2022, 9, 17),
        "3/7/2005": date(2005, 3, 7), "01/06/17": date(2017, 1, 6), "1/6/97": date(2097, 1, 6),
        "14-07-2025": date(2025, 7, 14), "4-7-2025": date(2025, 7, 4),
        "2025/02/01": date(2025, 2, 1), "October 2, 2018": date(2018, 10, 2),
        "october 2, 2018": date(2018, 10, 2), "Sep 11, 2024": date(2024, 9, 11),
        "2025-1-5": date(2025, 1, 5), "2025/2/1": date(2025, 2, 1),
        "October  2, 2018": date(2018, 10, 2), "12/ 8/2008": date(2008, 12, 8),
        "\t2024-01-31 ": date(2024, 1, 31), "12/ 8/97": date(1997, 12, 8),
        "12/ 8/08": date(2008, 12, 8), "1997-12- 8": date(1997, 12, 8),
        "2021-02-30": None, "13/01/2020": None, "Sept 11, 2024": None,
        "2023-11-22T22:59:32": None, "4-7-25": None, "10000-01-01": None, "12/  8/2008": None,
        "1997/ 8/13": None, "12/12/1": None, "soon": None, "": None, " ": None, None: None,
    })


def _every_layout(spark, parse, try_parse, layouts, values):
    rows = spark.createDataFrame([(v,) for v in values], "c string")
    one_by_one = F.coalesce(*(try_parse(F.col("c"), layout) for layout in layouts))
    both = rows.select("c", parse(F.col("c")).alias("ours"), one_by_one.alias("theirs"))
    return both.where(~F.col("ours").eqNullSafe(F.col("theirs"))).collect()


def test_one_date_pattern_means_the_same_as_every_layout_in_turn(spark):
    parts = ["1", "12", "05", "31", "13", "00", "2025", "1997", "97", "01", "68", "029"]
    values = [
        a + s + b + s2 + c for a in parts for b in parts for c in parts
        for s, s2 in (("/", "/"), ("-", "-"), ("/", "-"), (" ", ", "))
    ] + [f"{m} {d}, {y}" for m in ("May", "october", "OCT", "Sept") for d in parts for y in parts]
    layouts = [*fixed.DATE_FORMATS, "yyyy-M-d", "yyyy/M/d", "MMM d, yyyy"]
    differing = _every_layout(spark, fn.parse_date, F.try_to_date, layouts, values)
    # Only the strict layouts limit a year-first day or month to two digits, and here a short
    # month is followed by two digits at most.
    assert [r for r in differing if not r["c"].startswith(("2025", "1997", "OCT 029"))] == []
    assert all("029" in r["c"] or "1997" in r["c"][4:] or "2025" in r["c"][4:] for r in differing)


def test_one_timestamp_pattern_means_the_same_as_every_layout_in_turn(spark):
    days = ["2025-01-05", "2025/01/05", "05-01-2025", "5-1-2025", "01/05/2025", "1/5/2025",
            "1/5/25", "01/05/25", "13/40/2025", "2025-1-5", "05/16/24", "2024-02-30"]
    times = ["", "10:20", "1:20", "10:20:30", "1:20:30", "10:20:30.123456", "10:20:30.1",
             "10:20:30.", "10:20 AM", "1:20 PM", "13:20 PM", "25:00", "01:20 am", "10:20:30Z"]
    values = [d + s + t for d in days for s in ("", " ", "T") for t in times]
    differing = _every_layout(
        spark, fn.parse_timestamp, lambda c, f: F.try_to_timestamp(c, F.lit(f)),
        fixed.TIMESTAMP_FORMATS, values,
    )
    assert differing == []


def test_usual_dates_need_no_pattern(spark, monkeypatch):
    """A pattern costs far more than all else that is done to a date."""
    monkeypatch.setattr(dates, "DATE_PATTERN", "'none'")
    monkeypatch.setattr(dates, "TIMESTAMP_PATTERN", "'none'")
    day = date(2024, 2, 9)
    for rule, found in ((fn.parse_date, day), (fn.date_text, "2024-02-09")):
        texts = ["2024-02-09", "2024/02/09", "2/9/2024", "02/09/2024", "2/9/24", "9-2-2024", "09-02-2024",
                 "February 9, 2024", "February 09, 2024", "Feb 9, 2024"]
        check(spark, rule, dict.fromkeys(texts, found) | dict.fromkeys(
            ["2024-02/09", "2024-2-9 ", "2024", "30-02-2024", "02/30/2024", "Febr 9, 2024", "2024-02-09T", "2024-02-09\n"]
        ))
    check(spark, fn.parse_timestamp, {
        "2024-02-09T03:04:05.000006": datetime(2024, 2, 9, 3, 4, 5, 6),
        "2024-02-09T03:04:05": datetime(2024, 2, 9, 3, 4, 5), "2024-02-09 03:04:05": datetime(2024, 2, 9, 3, 4, 5),
        "09-02-2024 03:04:05": datetime(2024, 2, 9, 3, 4, 5), "09-02-2024 03:04": datetime(2024, 2, 9, 3, 4),
        "2/9/2024 3:04:05": datetime(2024, 2, 9, 3, 4, 5), "02/09/2024 03:04": datetime(2024, 2, 9, 3, 4),
        "02/09/24 03:04": datetime(2024, 2, 9, 3, 4), "2/9/24": datetime(2024, 2, 9), "2024/02/09": datetime(2024, 2, 9),
        "09-02-2024": datetime(2024, 2, 9), "2024-02-09": datetime(2024, 2, 9),
        "2/9/2024": None, "2/9/24 03:04": None, "9-2-2024": None, "2024-02-09 24:00:00": None, "2024-02-09 3:04:05": None,
    })


def test_sentinels_are_told_by_length_only_where_it_tells(spark):
    texts = ["N/A", "n/a", "NULL", "Null", "", "-", "Not Provided", "not provided ", "nullo", "\u212a", "k", "K", "\u0130", None]
    for sentinels in (fixed.SENTINELS, ("k",), ("\u00e5", "-"), ()):
        expected = {t: None if t is None or t.lower() in sentinels else t for t in texts}
        check(spark, lambda c, s=sentinels: fn.null_if_sentinel(c, s), expected)


def test_two_dates_are_no_date(spark):
    dates = ["2024-01-05", "2024/01/05", "1/5/2024", "1/5/24", "5-1-2024", "January 5, 2024", "Jan 5, 2024"]
    times = ["2024-01-05T10:20:30", "2024-01-05 10:20:30", "05-01-2024 10:20", "1/5/24", "2024/01/05"]
    glued = [a + b for a in dates for b in dates]
    assert set(apply(spark, fn.parse_date, glued)) == {None}
    assert set(apply(spark, fn.parse_timestamp, [a + b for a in times for b in times])) == {None}


def test_parse_timestamp(spark):
    check(spark, fn.parse_timestamp, {
        "2023-11-22T22:59:32.609491": datetime(2023, 11, 22, 22, 59, 32, 609491),
        "2023-11-23T09:11:25": datetime(2023, 11, 23, 9, 11, 25),
        "23-05-2025 01:56:13": datetime(2025, 5, 23, 1, 56, 13),
        "05/24/2025 08:46": datetime(2025, 5, 24, 8, 46),
        "1/3/24 9:01 PM": datetime(2024, 1, 3, 21, 1),
        "01/03/24 13:01": datetime(2024, 1, 3, 13, 1),
        "01-08-2021": datetime(2021, 8, 1),
        "2023-11-23T09:11:25Z": None, "1/3/24 13:01": None, "09/17/2022": None, "": None,
    })


def test_age(spark):
    as_of = date(2026, 6, 27)
    assert apply(spark, lambda c: fn.age_in_years(c, as_of), [date(2006, 6, 27), None], "date") == [20, None]
    born = [date(2024, 6, 27)]
    assert apply(spark, lambda c: fn.age_in_years(c, date(2025, 6, 27)), born, "date") == [0]
    assert apply(spark, lambda c: fn.age_in_years(c, date(2025, 6, 27), True), born, "date") == [1]


def test_money(spark):
    check(spark, fn.money, {"$1,234.50": 1234.5, "1234.50 USD": 1234.5, "-50.25": 50.25,
                            "(50)": 50.0, "1.234,50": 1.2345, "free": None, "": None, "1.2.3": None})
    check(spark, lambda c: fn.money(c, signed=True), {"-50.25": -50.25, "(50)": -50.0, "5-6": 56.0})


def test_operator_prefix(spark):
    check(spark, fn.strip_operator_prefix,
          {"> 5": "5", "<=3.1": "3.1", ">=  7": "7", "≥9": "≥9", "!": "", None: None})
    check(spark, fn.has_operator_prefix, {"> 5": True, "≥9": False, "5": False, None: False})


def test_text(spark):
    check(spark, fn.strip_trailing_punctuation,
          {"25mg.": "25mg", "25 mg . ": "25 mg", "..": "", "2.5mg": "2.5mg"})
    check(spark, fn.title_case, {"ON-hold now": "On-hold Now"})
    check(spark, fn.mask_id, {"PAT-0001": "PAT-***", "ab": "ab***", None: "None***"})
    check(spark, fn.null_if_sentinel, {"N/A": None, "Null": None, "-": None, "": None, "x": "x"})


def test_categories(spark):
    gender = lambda c: fn.category_or_default(c, fixed.GENDERS, fixed.GENDER_OTHER)
    check(spark, gender, {"M": "Male", "woman": "Female", "Non Binary": "Non-binary",
                          "x": "Other", None: None})
    route = lambda c: fn.category_or_upper(c, fixed.ROUTES)
    check(spark, route, {"P.O.": "PO", "iv": "IV", "rectal": "RECTAL", None: None})


def test_flags(spark):
    check(spark, fn.flag, {"Yes": True, "1": True, "F": False, "0": False, "maybe": None, None: None})
    check(spark, fn.affirmative, {"Y": True, "t": False, "no": False, None: None})
    check(spark, lambda c: fn.flag_text(fn.flag(c)), {"y": "True", "n": "False", "?": None})


def test_numbers(spark):
    check(spark, fn.to_double, {" 5 ": 5.0, "x": None, "": None})
    check(spark, fn.finite_or_null, {"NaN": None, "1": 1.0, "Infinity": None, "-Infinity": None})
    check(spark, lambda c: fn.clamp(c, 0.0, 100.0), {101.0: 100.0, -1.0: 0.0, 5.0: 5.0}, "double")
    assert apply(spark, lambda c: fn.clamp(c, 0.0, 100.0), [None], "double") == [None]
    assert apply(spark, lambda c: fn.over_limit(c, 100.0), [100.0, 100.5, None], "double") == [
        False, True, False]
    check(spark, fn.fahrenheit_to_celsius, {98.6: 37.0, 37.5: 37.5, 50.0: 50.0}, "double")


@pytest.mark.parametrize("part", [0, 1, 7, 25, 27, 333, 400])
def test_percent_rounds_like_the_exact_binary_value(spark, part):
    row = spark.range(1).select(fn.percent_text(F.lit(part), F.lit(400)).alias("r")).first()
    assert row["r"] == f"{part / 400:.1%}"
    nothing = spark.range(1).select(fn.percent_text(F.lit(part), F.lit(0)).alias("r")).first()
    assert nothing["r"] == "N/A"
