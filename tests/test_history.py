"""The ledger of runs: each run beside the others, and what changed between them."""

import pytest

from rowgate.operators.history import verdict_history, with_drift
from rowgate.sources import read_ledger, record_run

SCHEMA = "run_id string, `table` string, `check` string, ord int, row_count bigint, fail_count bigint, pass boolean, sample_ids array<string>"


def results(spark, run_id, *checks):
    rows = [(run_id, "t", name, i, n, bad, None if bad is None else bad == 0, None) for i, (name, n, bad) in enumerate(checks)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture
def ledger(spark, tmp_path):
    path = f"{tmp_path}/ledger"
    record_run(results(spark, "b", ("null_k", 10, 0), ("range", 10, 1), ("old", 10, 0)), path, "2026-01-01", "v1")
    record_run(results(spark, "a", ("null_k", 20, 1), ("range", 20, 1), ("young", 20, 0)), path, "2026-01-02", "v2")
    record_run(results(spark, "2026:c/x", ("null_k", 20, 0), ("range", 20, 2), ("old", 20, None)), path, "2026-01-03")
    return path


def test_changes_are_told_from_the_run_before(spark, ledger):
    rows = {(r.run_id, r.check): r for r in with_drift(read_ledger(spark, ledger)).collect()}
    assert {k: (r.previous_run, r.change) for k, r in rows.items()} == {
        ("b", "null_k"): (None, "new"), ("b", "range"): (None, "new"), ("b", "old"): (None, "new"),
        ("a", "null_k"): ("b", "broken"), ("a", "range"): ("b", "better"), ("a", "young"): (None, "new"),
        ("2026:c/x", "null_k"): ("a", "fixed"), ("2026:c/x", "range"): ("a", "worse"), ("2026:c/x", "old"): ("b", "broken"),
    }
    assert rows["a", "null_k"].drift == pytest.approx(0.05) and rows["a", "range"].drift == pytest.approx(-0.05)
    assert rows["2026:c/x", "old"].drift is None


def test_one_verdict_per_run(spark, ledger):
    rows = {r.run_id: r for r in verdict_history(read_ledger(spark, ledger)).collect()}
    assert [(r.run_id, r.publish, r.failed, r.critical, r.broken, r.fixed) for r in sorted(rows.values(), key=lambda r: r.recorded_at)] == [
        ("b", False, 1, 1, 0, 0), ("a", False, 2, 1, 1, 0), ("2026:c/x", False, 2, 1, 1, 1),
    ]
    assert rows["a"].data_version == "v2" and rows["a"].largest_drift == pytest.approx(0.05)


def test_recording_again_replaces_that_run_only(spark, ledger):
    record_run(results(spark, "a", ("null_k", 20, 0)), ledger, "2026-01-02")
    found = read_ledger(spark, ledger)
    assert found.count() == 3 + 1 + 3 and found.where("run_id = 'a'").first()["fail_count"] == 0
    record_run(results(spark, "d", ("null_k", 20, 0)).unionAll(results(spark, "e", ("null_k", 20, 9))), ledger, "2026-01-04")
    assert {r.run_id for r in read_ledger(spark, ledger).select("run_id").distinct().collect()} == {"b", "a", "2026:c/x", "d", "e"}


def test_other_runs_are_not_read(spark, ledger):
    plan = read_ledger(spark, ledger).where("run_id = 'a'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run_id" in plan


def test_no_ledger_yet(spark, tmp_path):
    empty = read_ledger(spark, f"{tmp_path}/none")
    assert empty.count() == 0 and verdict_history(empty).count() == 0
