"""Clean and quarantined rows change together, and their counts come from the jobs that wrote them."""

import os

import pytest
from pyspark.sql import functions as F

from rowgate.operators.rules import Required, Within
from rowgate.operators.split import MALFORMED_ROW, UNNAMED
from rowgate.plans import lifecycle
from rowgate.plans.contract import NotOutlying, References, TableContract, Unique
from rowgate.plans.lifecycle import clean_stage
from rowgate.sources import expire, manifests, read_clean, read_manifest, read_quarantine, read_rejected, read_version, versions, write_split

CONTRACT = TableContract("t", "id", rules=[Required("null v", "v"), Unique(("id",))])


def clean(spark, out, rows, contract=CONTRACT):
    spark.createDataFrame(rows, "id string, v string").write.csv(f"{out}/raw", header=True, mode="overwrite")
    return clean_stage(spark, {"t": contract}, {"t": f"{out}/raw"}, f"{out}/cleaned", f"{out}/quarantine", "r")[0]


def both(spark, out, version=None):
    accepted = read_clean(spark, f"{out}/cleaned", "t", version).collect()
    rejected = read_rejected(spark, f"{out}/cleaned", f"{out}/quarantine", "t", version).collect()
    return sorted(map(tuple, accepted)), sorted(map(tuple, rejected), key=str)


FIRST = [("1", "a"), ("2", None), ("1", "b")]
SECOND = [("5", "x"), ("6", "y"), ("7", None)]
FIRST_SPLIT = ([("1", "a")], [("1", "b", "duplicate primary key"), ("2", None, "null v")])


@pytest.mark.parametrize("at", ["before the commit", "within the commit", "by another run"])
def test_a_failure_between_both_sides_leaves_one_version(spark, tmp_path, monkeypatch, at):
    clean(spark, tmp_path, FIRST)
    before = read_manifest(spark, f"{tmp_path}/cleaned")
    if at == "before the commit":
        monkeypatch.setattr(versions.NewVersion, "commit", lambda *_: (_ for _ in ()).throw(OSError("lost")))
    elif at == "within the commit":
        def torn(spark, file, content, write=versions.write_json):
            write(spark, file, content)
            raise OSError("lost")

        monkeypatch.setattr(versions, "write_json", torn)
    else:
        monkeypatch.setattr(versions, "_numbers", lambda *_: [])  # as they were before the other run
    with pytest.raises((OSError, RuntimeError)):
        clean(spark, tmp_path, SECOND)
    monkeypatch.undo()
    assert read_manifest(spark, f"{tmp_path}/cleaned") == before
    assert both(spark, tmp_path) == FIRST_SPLIT
    assert os.listdir(f"{tmp_path}/quarantine") == [before["version"]]
    clean(spark, tmp_path, SECOND)
    assert [r[0] for r in both(spark, tmp_path)[0]] == ["5", "6"]


def test_old_versions_stay_readable_until_they_expire(spark, tmp_path):
    clean(spark, tmp_path, FIRST)
    held = read_clean(spark, f"{tmp_path}/cleaned", "t")  # a reader that began before
    clean(spark, tmp_path, SECOND)
    clean(spark, tmp_path, SECOND[:1])
    first, second, third = (m["version"] for m in manifests(spark, f"{tmp_path}/cleaned"))
    assert held.count() == 1 and both(spark, tmp_path, first) == FIRST_SPLIT
    assert [len(side) for side in both(spark, tmp_path, second)] == [2, 1]
    assert expire(spark, f"{tmp_path}/cleaned", f"{tmp_path}/quarantine", keep=1) == [first, second]
    assert [r[0] for r in both(spark, tmp_path)[0]] == ["5"]
    with pytest.raises(FileNotFoundError):
        read_manifest(spark, f"{tmp_path}/cleaned", first)
    with pytest.raises(ValueError):
        expire(spark, f"{tmp_path}/cleaned", f"{tmp_path}/quarantine", keep=0)


def test_gold_tables_of_earlier_runs_stay(spark, tmp_path):
    """A versioned gold table changes by a commit; one that may not be published leaves it as it is."""
    gold = f"{tmp_path}/gold"

    def publish(rows, run_id, allowed=True, again=1):
        fact = spark.createDataFrame(rows, "id string, v string")
        verdict = spark.createDataFrame([(run_id, allowed, "no")], "run_id string, publish boolean, summary string")
        wide = fact.withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(again))))
        return lifecycle.publish_if(verdict, run_id, fact, wide, gold, versioned=True)

    assert publish(FIRST, "r1") == 3 and publish(SECOND[:2], "r2") == 2
    for fault, options in ((lifecycle.PublishBlocked, {"allowed": False}), (RuntimeError, {"again": 2})):
        with pytest.raises(fault):
            publish(SECOND, "r3", **options)
    first, second = manifests(spark, gold)
    assert [(m["run_id"], m["rows"]) for m in (first, second)] == [("r1", 3), ("r2", 2)]
    assert read_version(spark, gold).count() == 2 and read_version(spark, gold, first["version"]).count() == 3
    assert sorted(os.listdir(gold)) == sorted([first["version"], second["version"], "_versions"])
    assert expire(spark, gold, keep=1) == [first["version"]] and read_version(spark, gold).count() == 2


def test_counts_come_from_the_jobs_that_read_and_write(spark, tmp_path, monkeypatch):
    """No table is counted, and none is read between its write and the commit but as a parent."""
    for name in ("count", "collect", "first"):
        monkeypatch.setattr(type(spark.range(0)), name, lambda *_: pytest.fail("a job that only counts"))
    line = clean(spark, tmp_path, FIRST)
    monkeypatch.undo()
    assert line == lifecycle.Account("t", 3, 1, 2, {"null v": 1, "duplicate primary key": 1})
    assert read_manifest(spark, f"{tmp_path}/cleaned")["tables"][0]["by_reason"] == line.by_reason


def test_contracts_without_keys_are_counted_too(spark, tmp_path):
    line = clean(spark, tmp_path, FIRST, TableContract("t", "id", rules=[Required("null v", "v")]))
    assert line == lifecycle.Account("t", 3, 2, 1, {"null v": 1})
    line = clean(spark, tmp_path, [], TableContract("t", "id"))
    assert line == lifecycle.Account("t", 0, 0, 0, {})


def test_rows_that_are_lost_or_change_sides_are_noticed(spark, tmp_path, monkeypatch):
    clean(spark, tmp_path, FIRST)
    tag = lifecycle.tag_table
    reason = F.col("rejection_reason")
    for fault in (
        lambda df: df.where(reason.isNull()),  # loses rows
        lambda df: df.withColumn("rejection_reason", F.coalesce(reason, F.lit("other"))),
        lambda df: df.withColumn("rejection_reason", F.coalesce(reason, F.lit(" "))),
    ):
        monkeypatch.setattr(lifecycle, "tag_table", lambda *a, fault=fault: fault(tag(*a)))
        with pytest.raises((RuntimeError, ValueError), match="add up|other reasons"):
            clean(spark, tmp_path, SECOND)
    monkeypatch.undo()
    assert both(spark, tmp_path) == FIRST_SPLIT


def test_an_empty_reason_is_refused_by_a_contract_and_quarantined_in_a_table(spark, tmp_path):
    for rule in (Required("", "v"), Within(" ", {"v": (0, 1)}), Required(None, "v")):
        with pytest.raises(ValueError, match="no reason"):
            TableContract("t", "id", rules=[rule])
    tagged = spark.createDataFrame([(1, None), (2, ""), (3, "bad"), (4, "  ")], "id int, rejection_reason string")
    counts = write_split(tagged, f"{tmp_path}/clean", f"{tmp_path}/rejected")
    assert (counts.rows, counts.accepted, counts.rejected, counts.by_reason) == (4, 1, 3, {UNNAMED: 2})
    accepted = spark.read.parquet(f"{tmp_path}/clean")
    assert [r.id for r in accepted.collect()] == [1]
    rejected = read_quarantine(spark, f"{tmp_path}/rejected", accepted.schema).collect()
    assert sorted(tuple(r) for r in rejected) == [(2, UNNAMED), (3, "bad"), (4, UNNAMED)]


def test_reasons_of_a_contract_are_those_of_its_rules():
    rules = [Required("null id", "id"), Unique(("id",)), NotOutlying(("a", "b")), References("p", "parents")]
    found = TableContract("t", "id", rules=rules).reasons
    assert found == ["null id", "duplicate primary key", "zscore_outlier_a", "zscore_outlier_b", "fk_p not in parents"]


def test_malformed_lines_are_counted_and_kept_as_they_stand(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "a.csv").write_text('id,v\n1,a\n2,b,extra\n3\n"4","x,y"\n1,c,d,e\n,\n5,"q, z"\n')
    line = clean_stage(spark, {"t": CONTRACT}, {"t": f"{tmp_path}/raw"}, f"{tmp_path}/cleaned", f"{tmp_path}/quarantine", "r")[0]
    assert line == lifecycle.Account("t", 7, 3, 4, {MALFORMED_ROW: 3, "null v": 1})
    accepted, _ = both(spark, tmp_path)
    assert accepted == [("1", "a"), ("4", "x,y"), ("5", "q, z")]
    lines = read_rejected(spark, f"{tmp_path}/cleaned", f"{tmp_path}/quarantine", "t", lines=True)
    found = {r["_malformed"] and r["_malformed"]["line"]: (r.id, r.rejection_reason) for r in lines.collect()}
    assert found == {
        "2,b,extra": ("2", MALFORMED_ROW), "3": ("3", MALFORMED_ROW), "1,c,d,e": ("1", MALFORMED_ROW), None: (None, "null v"),
    }
    assert read_clean(spark, f"{tmp_path}/cleaned", "t").columns == ["id", "v"]
