"""Ranges from Parquet footers, and from the rows where footers cannot tell them."""

import math

import pytest
from pyspark.sql import functions as F

from rowgate.operators import histogram
from rowgate.operators.checks import (
    DateBetween, NoOutliers, NotNull, NumberBetween, Suite, _count_table, _decided_by_files, run_checks,
)
from rowgate.operators.footers import footer_ranges, pushed_ranges
from rowgate.operators.histogram import Axis, histograms
from rowgate.session import settings


@pytest.fixture
def table(spark, tmp_path):
    def write(*values, kind="double"):
        path = f"{tmp_path}/{abs(hash((values, kind)))}"
        rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"k bigint, `v.x` {kind}")
        rows.repartition(3).write.parquet(path)
        return spark.read.parquet(path)

    return write


def test_footers_answer_without_reading_rows(table):
    df = table(3.5, None, -0.0, 12.25, 7.0, 0.0)
    assert footer_ranges(df, ["v.x", "K"]) == [(0.0, 12.25), (0.0, 5.0)]
    assert math.copysign(1, footer_ranges(df, ["v.x"])[0][0]) == 1
    plan = pushed_ranges(df, ["v.x"])._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [MIN" in plan and "ReadSchema: struct<min(" in plan


@pytest.mark.parametrize("values", [(1.0, math.nan, 2.0), (1.0, math.inf), (-math.inf, 1.0), (None, None)])
def test_rows_tell_what_footers_do_not(table, values):
    df = table(*values)
    assert footer_ranges(df, ["v.x"]) is None
    charted = histograms({"t": df}, [Axis("t", "v.x")], 4) if values[0] is not None else None
    finite = [v for v in values if v is not None and math.isfinite(v)]
    if charted:
        assert charted.agg(F.sum("row_count")).first()[0] == len(finite)
        assert charted.agg(F.min("low"), F.max("high")).first()[0] <= min(finite)


def test_only_whole_parquet_tables_of_numbers_have_footers(spark, table, tmp_path):
    df = table(1.0, 2.0)
    assert footer_ranges(df.where("k > 0"), ["v.x"]) is None
    assert footer_ranges(df.limit(1), ["v.x"]) is None
    assert footer_ranges(df.union(df), ["v.x"]) is None
    assert footer_ranges(table("1", "2", kind="string"), ["v.x"]) is None
    df.select("k").write.csv(f"{tmp_path}/csv", header=True)
    assert footer_ranges(spark.read.csv(f"{tmp_path}/csv", header=True, schema="k bigint"), ["k"]) is None


def test_a_histogram_scans_its_table_once(table, monkeypatch):
    df = table(*(float(i * i % 97) for i in range(500)))
    axes = [Axis("t", "v.x", 0.0, 50.0), Axis("t", "k")]
    found = sorted(map(tuple, histograms({"t": df}, axes).collect()))
    monkeypatch.setattr(histogram, "_scanned_ranges", lambda *_: pytest.fail("the rows were read for their range"))
    assert sorted(map(tuple, histograms({"t": df}, axes).collect())) == found
    monkeypatch.undo()
    monkeypatch.setattr(histogram, "footer_ranges", lambda *_: None)
    assert sorted(map(tuple, histograms({"t": df}, axes).collect())) == found


def test_the_session_keeps_its_readers(spark, table):
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    footer_ranges(table(1.0, 2.0), ["v.x"])
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before


SUITE = Suite("t", "k", [
    NotNull("null_k", "k"), NumberBetween("v_range", "v", 0.0, 90.0), NumberBetween("n_range", "n", 10, None),
    DateBetween("day_range", "day", "2000-01-01", "2001-01-01"), NumberBetween("w_range", "w", 0.0, 1.0), NoOutliers("w_far", "w"),
    NumberBetween("text_range", "text", 0.0, 90.0),
])


@pytest.fixture
def typed(spark, tmp_path):
    value = "if(id % 50 = 7, double('NaN'), if(id % 9 = 0, null, id % 100))"
    spark.range(1000).selectExpr(
        "id as k", f"{value} as v", "cast(id % 40 as int) as n", "date_add(date'1999-12-30', cast(id % 400 as int)) as day",
        "id / 1000 as w", "cast(id % 100 as string) as text",
    ).repartition(4).write.parquet(f"{tmp_path}/typed")
    return spark.read.parquet(f"{tmp_path}/typed")


def test_ranges_are_filters_that_reach_the_scan(spark, typed):
    assert set(_decided_by_files(typed, SUITE)) == {"v_range", "n_range", "day_range"}
    with settings(spark, {"spark.sql.maxMetadataStringLength": "2000"}):
        plan = _count_table(typed, SUITE, {})._jdf.queryExecution().executedPlan().toString()
    pushed = [line for line in plan.splitlines() if "FileScan" in line and "PushedFilters: [Or(" in line]
    assert len(pushed) == 1 and all(f in pushed[0] for f in ("LessThan(n,10)", "GreaterThan(v,90.0)", "GreaterThan(day,2001-01-01)"))
    others = [line for line in plan.splitlines() if "FileScan" in line and line not in pushed]
    assert len(others) == 1 and "ReadSchema: struct<k:bigint,w:double,text:string>" in others[0]


def test_filtered_checks_count_what_the_one_pass_counts(typed):
    """The same rows as a derived table, which has no statistics, are counted in one pass."""
    def counts(df):
        return sorted((r.check, r.row_count, r.fail_count, tuple(r.sample_ids or ())) for r in run_checks({"t": df}, [SUITE], "r").collect())

    assert counts(typed) == counts(typed.select("*")) and dict((c, n) for c, _, n, _ in counts(typed))["v_range"] > 0


def test_row_groups_within_the_limits_are_not_read(spark, tmp_path):
    """A file that holds no row beyond the limits is skipped; one that cannot be read shows it."""
    spark.range(100).selectExpr("id as k", "cast(id as double) as v").coalesce(1).write.parquet(f"{tmp_path}/t")
    (file,) = [f for f in (tmp_path / "t").iterdir() if f.suffix == ".parquet"]
    data = bytearray(file.read_bytes())
    data[4:200] = bytes(196)  # the pages, not the footer
    file.write_bytes(data)
    (tmp_path / "t" / f".{file.name}.crc").unlink()
    df = spark.read.parquet(f"{tmp_path}/t")
    within, beyond = NumberBetween("v_range", "v", 0.0, 99.0), NumberBetween("v_range", "v", 0.0, 50.0)
    assert run_checks({"t": df}, [Suite("t", "k", [within])], "r").first()["fail_count"] == 0
    with pytest.raises(Exception):
        run_checks({"t": df}, [Suite("t", "k", [beyond])], "r").collect()
