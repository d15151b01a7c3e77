"""Tagging, checks and verdicts on small tables with known outcomes."""

import json
from collections import Counter
from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from rowgate.operators import checks as ck
from rowgate.operators.duplicates import tag_duplicates
from rowgate.operators.enrich import Dimension, enrich
from rowgate.operators.histogram import Axis, histograms
from rowgate.operators.normalize import normalize, nullify_sentinels, trim_strings
from rowgate.operators.outliers import is_outlier, moments, tag_outliers
from rowgate.operators.references import tag_orphans
from rowgate.operators.rules import NotAfter, Required, Within, tag_rows
from rowgate.operators.split import clean_rows, quarantined_rows
from rowgate.operators.verdict import failures, verdicts
from rowgate.plans.lifecycle import PublishBlocked, may_publish, publish_if
from rowgate.sources import read_report, read_verdict, write_report, write_verdict


def reasons(df, key="k"):
    return {row[key]: row["rejection_reason"] for row in df.collect()}


def test_normalize_keeps_other_types_and_odd_names(spark):
    df = spark.createDataFrame([(1, " N/A ", " x "), (2, "\tNULL", None)], "k int, `a.b` string, c string")
    out = normalize(df, derived={"size": ("c", F.length)}).orderBy("k").collect()
    assert [tuple(r) for r in out] == [(1, None, "x", 1), (2, "\tNULL", None, None)]
    assert trim_strings(df, " \t").orderBy("k").collect()[1]["a.b"] == "NULL"
    assert nullify_sentinels(df).orderBy("k").collect()[0]["a.b"] == " N/A "


def test_first_broken_rule_names_the_reason(spark):
    df = spark.createDataFrame(
        [(1, None, None), (2, "2030-01-01", 5.0), (3, "2020-01-01", 50.0), (4, "2020-01-01", None)],
        "k int, d string, v double",
    )
    rules = [Required("no date", "d"), NotAfter("future", "d", date(2026, 1, 1)),
             Within("range", {"v": (0.0, 10.0)})]
    assert reasons(tag_rows(df, rules)) == {1: "no date", 2: "future", 3: "range", 4: None}


def test_exactly_one_row_stays_per_key_even_among_equal_rows(spark):
    rows = [("a", 1)] * 5 + [("b", 2), ("b", 1), ("c", 9)] + [(None, 3), (None, 4)]
    df = spark.createDataFrame(rows, "k string, v int").repartition(4)
    for order in ([], ["v"]):
        tagged = tag_duplicates(df, "k", order)
        clean, rejected = clean_rows(tagged), quarantined_rows(tagged)
        assert sorted((r["k"] or "") for r in clean.collect()) == ["", "a", "b", "c"]
        assert rejected.count() == len(rows) - 4
        if order:
            kept = {r["k"]: r["v"] for r in clean.collect()}
            assert kept == {"a": 1, "b": 1, "c": 9, None: 3}


def test_copies_of_a_rejected_row_are_not_duplicates(spark):
    df = spark.createDataFrame([(1, "a", 50.0), (2, "a", 5.0), (3, "a", 6.0)], "k int, id string, v double")
    tagged = tag_rows(df, [Within("range", {"v": (0.0, 10.0)})])
    tagged = tag_duplicates(tagged, "id", ["k"])
    assert reasons(tagged) == {1: "range", 2: None, 3: "duplicate primary key"}


@pytest.mark.parametrize("limit", ["10485760", "-1"])
def test_a_key_with_a_third_of_the_rows(spark, limit):
    """Same rows whether the key lists are broadcast or shuffled."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        df = spark.range(30000).selectExpr(
            "id as k", "if(id % 3 = 0, 'hot', concat('k', id div 2)) as key",
            "case when id % 3 = 1 then null when id % 7 = 0 then 'gone' else 'here' end as parent",
        )
        parents = spark.createDataFrame([("here",), (None,)], "p string")
        tagged = tag_duplicates(df, "key", ["k"])
        tagged = tag_orphans(tagged, "parent", parents, "orphan", "p")
        counts = Counter(reasons(tagged).values())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    seen, expected = set(), Counter()
    for k in range(30000):
        key = "hot" if k % 3 == 0 else f"k{k // 2}"
        if key in seen:
            expected["duplicate primary key"] += 1
        elif k % 3 == 1 or k % 7 == 0:
            expected["orphan"] += 1
        else:
            expected[None] += 1
        seen.add(key)
    assert counts == expected


def test_orphans(spark):
    child = spark.createDataFrame([(1, None), (2, "p"), (3, "q")], "k int, fk string")
    parent = spark.createDataFrame([("p",), ("p",), (None,)], "fk string")
    tagged = tag_orphans(child, "fk", parent, "orphan")
    assert reasons(tagged) == {1: "orphan", 2: None, 3: "orphan"}
    assert tagged.columns == ["k", "fk", "rejection_reason"]


def test_outliers_ignore_nan_and_constant_columns(spark):
    values = [1.0] * 30 + [2.0] * 30 + [100.0, float("nan"), None]
    df = spark.createDataFrame(list(enumerate(values)), "k int, v double").withColumn("one", F.lit(1.0))
    rejected = {k: r for k, r in reasons(tag_outliers(df, ["one", "v"])).items() if r}
    assert rejected == {60: "zscore_outlier_v"}
    single = df.limit(1)
    assert single.where(is_outlier("v", moments(single, ["v"]))).count() == 0


def test_sequential_outliers_use_the_survivors(spark):
    rng = np.random.default_rng(5)
    a = np.concatenate([rng.normal(0, 1, 400), [50.0, -40.0]])
    b = np.concatenate([rng.normal(0, 1, 400), [900.0, 30.0]])
    df = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(zip(a, b))],
                               "k int, a double, b double")
    left, expected = np.ones(len(a), bool), {}
    for name, column in (("a", a), ("b", b)):
        z = np.abs((column - column[left].mean()) / column[left].std(ddof=1))
        for i in np.flatnonzero(left & (z > 3)):
            expected[int(i)] = f"zscore_outlier_{name}"
        left &= ~(z > 3)
    found = {k: r for k, r in reasons(tag_outliers(df, ["a", "b"])).items() if r}
    assert found == expected


def test_histogram_equals_numpy(spark):
    rng = np.random.default_rng(3)
    values = np.round(rng.gamma(2, 30, 5000), 1)
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,), (float("nan"),)], "v double")
    out = histograms({"t": df}, [Axis("t", "v", 0, 9)]).orderBy("bin").collect()
    counts, edges = np.histogram(values, bins=50)
    assert [r["row_count"] for r in out] == counts.tolist()
    assert np.allclose([r["low"] for r in out], edges[:-1])
    flat = histograms({"t": spark.range(7).selectExpr("5.0D as v")}, [Axis("t", "v")])
    assert [r["row_count"] for r in flat.orderBy("bin").collect()] == np.histogram(
        [5.0] * 7, bins=50)[0].tolist()


def test_checks_count_and_sample(spark):
    df = spark.createDataFrame(
        [("id-00001", 5.0, "x"), ("id-00001", 50.0, None), ("id-00002", 60.0, "y"), (None, None, "x")],
        "id string, v double, fk string",
    )
    suite = ck.Suite("t", "id", [
        ck.NotNull("null_id", "id"), ck.NumberBetween("v_range", "v", 0.0, 10.0),
        ck.HasParent("fk_fk", "fk", "p"), ck.UniqueKey("duplicate_pk", "id"),
        ck.NoOutliers("v_zscore", "v"),
    ])
    parents = spark.createDataFrame([("x",)], "fk string")
    rows = {r["check"]: r for r in ck.run_checks({"t": df, "p": parents}, [suite], "run").collect()}
    assert {c: r["fail_count"] for c, r in rows.items()} == {
        "null_id": 1, "v_range": 2, "fk_fk": 2, "duplicate_pk": 1, "v_zscore": 0}
    assert {r["row_count"] for r in rows.values()} == {4}
    assert rows["null_id"]["sample_ids"] is None and rows["v_zscore"]["pass"]
    assert rows["v_range"]["sample_ids"] == ["id-0***", "id-0***"]
    assert rows["duplicate_pk"]["sample_ids"] == ["id-0***"]


def test_checks_of_an_empty_table_pass(spark):
    empty = spark.createDataFrame([], "id string, v double")
    suite = ck.Suite("t", "id", [ck.NotNull("null_id", "id"), ck.UniqueKey("duplicate_pk", "id"),
                                 ck.NoOutliers("z", "v")])
    results = ck.run_checks({"t": empty}, [suite], "run")
    assert [r["row_count"] for r in results.collect()] == [0, 0, 0]
    verdict = verdicts(results).first()
    assert verdict["publish"] and verdict["root_causes"] == []


def _results(spark, rows):
    return spark.createDataFrame(
        [("r", t, c, i, n, f, p) for i, (t, c, n, f, p) in enumerate(rows)],
        "run_id string, table string, check string, ord int, row_count long, fail_count long, "
        "pass boolean",
    )


def test_severity(spark):
    rows = [("t", "v_range", 100, 5, False), ("t", "v_zscore", 1000, 51, False),
            ("t", "fk_x", 100, 1, False), ("t", "nullable", 100, 1, False),
            ("t", "icd10_format", 0, 1, False), ("t", "ok", 100, 0, True), ("t", "odd", 100, 0, None)]
    found = {r["check"]: r for r in failures(_results(spark, rows)).collect()}
    assert {c: r["severity"] for c, r in found.items()} == {
        "v_range": "MINOR", "v_zscore": "CRITICAL", "fk_x": "CRITICAL", "nullable": "MINOR",
        "icd10_format": "CRITICAL", "odd": "MINOR"}
    assert found["v_zscore"]["root_cause"] == (
        "t.v_zscore: 51 rows (5.1%) — CRITICAL: exceeds 5% failure threshold (5.1% of table).")
    assert found["icd10_format"]["root_cause"] == (
        "t.icd10_format: 1 rows (N/A) — CRITICAL: malformed ICD-10 code.")


def test_verdict_lists_critical_causes_first(spark):
    rows = [("a", "v_range", 100, 1, False), ("b", "duplicate_pk", 100, 2, False)]
    verdict = verdicts(_results(spark, rows)).first()
    assert not verdict["publish"]
    assert [c.split(":")[0] for c in verdict["root_causes"]] == ["b.duplicate_pk", "a.v_range"]
    assert verdict["summary"].startswith("1 critical failure(s) detected")
    assert verdict["recommendations"][0] == (
        "Investigate and resolve b.duplicate_pk before re-running the pipeline.")


PASSING = {
    "patients": (7393, "null_patient_id future_dob dob_before_1900 duplicate_pk"),
    "encounters": (30498, "null_encounter_id future_encounter_date encounter_date_before_1900 "
                          "fk_patient_id fk_provider_id duplicate_pk"),
    "diagnoses": (69052, "null_diagnosis_id onset_date_before_1900 fk_encounter_id icd10_format "
                         "duplicate_pk"),
    "lab_results": (111817, "null_lab_id fk_encounter_id fk_patient_id duplicate_pk"),
    "medications": (70248, "null_medication_id fk_encounter_id fk_patient_id "
                           "adherence_rate_range adherence_rate_zscore duplicate_pk"),
    "providers": (458, "null_provider_id duplicate_pk"),
    "vitals": (38320, "null_vitals_id fk_encounter_id spo2_range spo2_zscore_outliers "
                      "heart_rate_range heart_rate_zscore_outliers temperature_range "
                      "temperature_zscore_outliers systolic_bp_range systolic_bp_zscore_outliers "
                      "diastolic_bp_range diastolic_bp_zscore_outliers duplicate_pk"),
}
FAILING = {"adherence_rate_zscore": 720, "spo2_zscore_outliers": 117,
           "heart_rate_zscore_outliers": 141, "temperature_zscore_outliers": 119,
           "systolic_bp_zscore_outliers": 211, "diastolic_bp_zscore_outliers": 526}


def test_a_stored_report_is_judged(spark, tmp_path):
    report = {"run_timestamp": "2026-06-26T10:20:28", "overall_pass": False, "tables": {
        t: {"row_count": n, "checks": {
            c: {"pass": c not in FAILING, "count": FAILING.get(c, 0)} for c in names.split()}}
        for t, (n, names) in PASSING.items()}}
    assert sum(len(t["checks"]) for t in report["tables"].values()) == 40
    path = tmp_path / "report.json"
    path.write_text(json.dumps(report, indent=2))
    verdict = verdicts(*read_report(spark, str(path))).first()
    assert verdict["publish"]
    assert verdict["summary"] == (
        "6 minor quality issue(s) detected but no critical failures — "
        "data is safe to publish with warnings.")
    labels = ["medications.adherence_rate_zscore"] + [
        f"vitals.{c}" for c in FAILING if c != "adherence_rate_zscore"]
    assert verdict["root_causes"] == [
        f"{label}: {FAILING[label.split('.')[1]]} rows — MINOR: low count, "
        "no referential integrity impact." for label in labels]
    assert verdict["recommendations"] == [
        f"Review {label} — acceptable to publish with monitoring." for label in labels]


def test_incomplete_reports(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_report(spark, str(tmp_path / "missing.json"))
    path = tmp_path / "report.json"
    path.write_text('{"tables": {"t": {"row_count": 5, "checks": {"a": {"count": 0}}}}}')
    verdict = verdicts(*read_report(spark, str(path))).first()
    assert verdict["publish"] and verdict["root_causes"][0].startswith("t.a: 0 rows — MINOR")
    path.write_text('{"overall_pass": true, "tables": {"t": {"checks": {"a": {"pass": false}}}}}')
    verdict = verdicts(*read_report(spark, str(path))).first()
    assert verdict["publish"] and verdict["root_causes"] == []
    assert verdict["summary"].startswith("All quality checks passed with no failures")
    path.write_text('{"tables": {}}')
    verdict = verdicts(*read_report(spark, str(path))).first()
    assert verdict["summary"].startswith("All quality checks passed — data is safe")
    path.write_text('{"summary": "x", "report_run_timestamp": "r"}')
    assert not may_publish(read_verdict(spark, str(path)), "r")


def test_written_report_reads_like_the_nested_layout(spark, tmp_path):
    rows = [("t", "a", 10, 0, True), ("t", "b", 10, 3, False), ("s", "a", 2, 0, True)]
    samples = F.when(F.col("fail_count") > 0, F.array(F.lit("id-1***")))
    write_report(_results(spark, rows).withColumn("sample_ids", samples), str(tmp_path / "r"))
    text = next((tmp_path / "r").glob("part-*")).read_text()
    report = json.loads(text)
    assert report == {"run_timestamp": "r", "overall_pass": False, "tables": {
        "t": {"row_count": 10, "checks": {
            "a": {"pass": True, "count": 0},
            "b": {"pass": False, "count": 3, "sample_ids_masked": ["id-1***"]}}},
        "s": {"row_count": 2, "checks": {"a": {"pass": True, "count": 0}}}}}
    assert list(report["tables"]) == ["t", "s"]


def test_gate(spark, tmp_path):
    fact = spark.createDataFrame([(1, 10), (2, 11)], "k int, d int")
    dim = spark.createDataFrame([(10, "x")], "d int, name string")
    gold = enrich(fact, {"dim": dim}, [Dimension("dim", "d", {"name": "dim_name"})])
    good = verdicts(_results(spark, [("t", "a", 10, 0, True)]))
    bad = verdicts(_results(spark, [("t", "fk_a", 10, 1, False)]))
    path = str(tmp_path / "gold")
    with pytest.raises(PublishBlocked, match="1 critical failure"):
        publish_if(bad, "r", fact, gold, path)
    with pytest.raises(PublishBlocked, match="no verdict for run other"):
        publish_if(good, "other", fact, gold, path)
    twice = enrich(fact, {"dim": dim.union(dim)}, [Dimension("dim", "d", {"name": "dim_name"})])
    with pytest.raises(RuntimeError, match="turned 2 rows into 3"):
        publish_if(good, "r", fact, twice, path)
    assert not (tmp_path / "gold").exists()
    assert publish_if(good, "r", fact, gold, path) == 2
    published = spark.read.parquet(path)
    assert published.columns == ["d", "k", "dim_name"]
    assert sorted(map(tuple, published.collect())) == [(10, 1, "x"), (11, 2, None)]


def test_verdict_file(spark, tmp_path):
    verdict = verdicts(_results(spark, [("t", "v_range", 10, 1, False)]))
    write_verdict(verdict, str(tmp_path / "v"), "now")
    stored = json.loads(next((tmp_path / "v").glob("part-*")).read_text())
    assert list(stored) == ["publish", "summary", "root_causes", "recommendations",
                            "agent_timestamp", "report_run_timestamp"]
    assert read_verdict(spark, str(tmp_path / "v")).drop("data_version").collect() == verdict.collect()
