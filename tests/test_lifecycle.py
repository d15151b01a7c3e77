"""The four stages on messy CSV files, and the properties a run must have."""

import os

import __spark_entry__ as book
import pytest
from pyspark.sql import functions as F

from querybook import Tables
from querybook.clinical import AS_OF, FIRST_BY, MESSY, RUN
from rowgate.__main__ import main
from rowgate.operators.checks import UniqueKey
from rowgate.operators.rules import Required
from rowgate.operators.split import quarantined_rows
from rowgate.plans import healthcare as preset
from rowgate.plans.contract import References, TableContract, Unique, in_parent_order, tag_table
from rowgate.plans.lifecycle import (
    PublishBlocked,
    check_stage,
    clean_stage,
    judge_stage,
    publish_if,
    publish_stage,
    tag_tables,
)
from rowgate.sources import StagingArea, expire, manifests, read_clean, read_csv, read_manifest, read_rejected, read_verdict

CONTRACTS = preset.healthcare(AS_OF, FIRST_BY)


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("run"))
    tables = Tables(spark, book.SMOKE_DIR)
    sources = {name: f"{out}/raw/{name}" for name in MESSY}
    for name, path in sources.items():
        MESSY[name](tables).repartition(3).write.csv(path, header=True)
    accounts = clean_stage(spark, CONTRACTS, sources, f"{out}/cleaned", f"{out}/quarantine")
    return out, sources, accounts


def _cleaned(spark, run, name):
    return read_clean(spark, f"{run[0]}/cleaned", name)


def test_no_row_is_lost(spark, run):
    out, sources, accounts = run
    assert [a.table for a in accounts] == list(CONTRACTS)
    for a in accounts:
        assert a.rows_in == read_csv(spark, sources[a.table]).count()
        assert a.rows_in == a.rows_cleaned + a.rows_quarantined
        assert a.rows_cleaned > 0 and a.rows_quarantined > 0
        quarantine = read_rejected(spark, f"{out}/cleaned", f"{out}/quarantine", a.table)
        assert a.by_reason == {r[0]: r[1] for r in quarantine.groupBy("rejection_reason").count().collect()}
        assert _cleaned(spark, run, a.table).count() == a.rows_cleaned
        assert quarantine.columns == [*_cleaned(spark, run, a.table).columns, "rejection_reason"]
        assert quarantine.where(F.col("rejection_reason").isNull()).isEmpty()


def test_rows_are_rejected_for_every_reason_of_the_preset(run):
    """The messy files break every rule, so that none can be lost unnoticed."""
    for account in run[2]:
        missing = set(CONTRACTS[account.table].reasons) - set(account.by_reason)
        # Of readings that move together, the first column judged takes the outliers.
        assert not {m for m in missing if not m.startswith("zscore_outlier")} and "zscore_outlier_spo2_pct" not in missing


def test_clean_keys_are_unique_and_have_parents(spark, run):
    for name, contract in CONTRACTS.items():
        df = _cleaned(spark, run, name)
        assert df.where(F.col(contract.key).isNull()).isEmpty()
        assert df.count() == df.select(contract.key).distinct().count()
        for rule in contract.rules:
            if isinstance(rule, References):
                parents = _cleaned(spark, run, rule.table).select(rule.column)
                assert df.join(parents, rule.column, "left_anti").isEmpty()


def test_files_give_the_same_split_as_tables(spark, run):
    """The CSV route rejects the same rows as tagging the tables directly."""
    tagged = tag_tables(
        {n: MESSY[n](Tables(spark, book.SMOKE_DIR)) for n in MESSY}, CONTRACTS, StagingArea(spark)
    )
    for name, df in tagged.items():
        expected = quarantined_rows(df)
        written = read_rejected(spark, f"{run[0]}/cleaned", f"{run[0]}/quarantine", name).select(expected.columns)
        assert written.exceptAll(expected).isEmpty() and expected.exceptAll(written).isEmpty()


@pytest.mark.parametrize("name", ["patients", "diagnoses", "lab_results"])
def test_cleaning_clean_rows_again_changes_nothing(spark, run, name):
    clean = _cleaned(spark, run, name)
    as_text = clean.select(*(F.col(c).cast("string") for c in clean.columns))
    contract = CONTRACTS[name]
    parents = {p: _cleaned(spark, run, p) for p in contract.parents}
    again = tag_table(as_text, contract, parents)
    assert quarantined_rows(again).isEmpty()
    key_and_dates = [c for c in clean.columns if c.endswith(("_id", "_date", "_code", "gender"))]
    assert again.select(key_and_dates).exceptAll(clean.select(key_and_dates)).isEmpty()


def test_check_judge_and_publish(spark, run):
    out = run[0]
    results = check_stage(spark, CONTRACTS, f"{out}/cleaned", f"{out}/report", RUN)
    assert results.count() == 40
    assert results.where(F.col("check").isin("duplicate_pk", "icd10_format", "fk_encounter_id")
                         & ~F.col("pass")).isEmpty()
    verdict = judge_stage(spark, f"{out}/report", f"{out}/verdict", "now").first()
    gold = f"{out}/gold"
    arguments = (spark, preset.FACT, preset.FACT_DIMENSIONS, f"{out}/cleaned", f"{out}/verdict", gold, RUN)
    if verdict["publish"]:
        assert publish_stage(*arguments) == _cleaned(spark, run, "encounters").count()
        assert spark.read.parquet(gold).columns[:2] == ["provider_id", "patient_id"]
    else:
        with pytest.raises(PublishBlocked):
            publish_stage(*arguments)


def test_first_copy_in_file_order_stays_without_an_order(spark, tmp_path):
    file = tmp_path / "t.csv"
    file.write_text("id,v\n" + "".join(f"{i % 10},{i}\n" for i in range(100)))
    contract = TableContract("t", "id", rules=[Unique(("id",))])
    tagged = tag_table(read_csv(spark, str(file)), contract, {})
    kept = tagged.where(F.col("rejection_reason").isNull()).collect()
    assert sorted(int(r["v"]) for r in kept) == list(range(10))


def test_provider_references_can_be_upper_cased(spark):
    tables = Tables(spark, book.SMOKE_DIR)
    raw = {n: MESSY[n](tables) for n in ("patients", "providers", "encounters")}
    rejected = {}
    for upper in (False, True):
        contracts = preset.healthcare(AS_OF, FIRST_BY, upper_provider_reference=upper)
        tagged = tag_tables(raw, {n: contracts[n] for n in raw}, StagingArea(spark))["encounters"]
        rejected[upper] = tagged.where(F.col("rejection_reason").contains("provider")).count()
    assert rejected[False] > rejected[True] > 0


def _orders_run(spark, out, rows):
    """Clean, check and judge one small table."""
    contract = TableContract("t", "id", rules=[Unique(("id",))], checks=[UniqueKey("duplicate_pk", "id")])
    spark.createDataFrame(rows, "id string, v string").write.csv(f"{out}/raw", header=True, mode="overwrite")
    arguments = (spark, {"t": contract}, {"t": f"{out}/raw"}, f"{out}/cleaned", f"{out}/quarantine", "r")
    clean_stage(*arguments)
    check_stage(spark, {"t": contract}, f"{out}/cleaned", f"{out}/report", "r")
    judge_stage(spark, f"{out}/report", f"{out}/verdict", "now")
    return arguments, (spark, "t", [], f"{out}/cleaned", f"{out}/verdict", f"{out}/gold", "r")


def test_only_the_judged_version_is_published(spark, tmp_path):
    clean, publish = _orders_run(spark, tmp_path, [("1", "a"), ("2", "b")])
    assert publish_stage(*publish) == 2
    clean_stage(*clean)
    with pytest.raises(PublishBlocked, match="cleaned again"):
        publish_stage(*publish)
    with pytest.raises(ValueError, match="cleaned by run r"):
        check_stage(spark, clean[1], clean[3], str(tmp_path / "report"), "another")


def test_a_failed_write_leaves_what_was_there(spark, tmp_path):
    clean, publish = _orders_run(spark, tmp_path, [("1", "a"), ("2", "b")])
    publish_stage(*publish)
    broken = F.raise_error(F.lit("no more")).cast("string")
    fact = read_clean(spark, f"{tmp_path}/cleaned", "t")
    verdict = read_verdict(spark, f"{tmp_path}/verdict")
    version = read_manifest(spark, f"{tmp_path}/cleaned")["version"]
    with pytest.raises(Exception, match="no more"):
        publish_if(verdict, "r", fact, fact.withColumn("v", broken), f"{tmp_path}/gold", version)
    with pytest.raises(RuntimeError, match="joins turned 2 rows into 4"):
        publish_if(verdict, "r", fact, fact.union(fact), f"{tmp_path}/gold", version)
    assert spark.read.parquet(f"{tmp_path}/gold").count() == 2
    contract = TableContract("t", "id", columns={"v": lambda c: F.raise_error(F.lit("no more")).cast("string")})
    with pytest.raises(Exception, match="no more"):
        clean_stage(spark, {"t": contract}, *clean[2:])
    assert read_clean(spark, f"{tmp_path}/cleaned", "t").count() == 2
    assert read_manifest(spark, f"{tmp_path}/cleaned")["version"] == version
    assert sorted(os.listdir(f"{tmp_path}/cleaned")) == sorted([version, "_versions"])
    assert os.listdir(f"{tmp_path}/quarantine") == [version]
    assert not [p for p in os.listdir(tmp_path) if p.startswith("_")]


def test_large_key_lists_give_the_same_split(spark, run, tmp_path):
    """The whole clean stage without broadcasts rejects the same rows."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        accounts = clean_stage(spark, CONTRACTS, run[1], f"{tmp_path}/cleaned", f"{tmp_path}/quarantine")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert accounts == run[2]


def test_first_copy_is_the_first_files_on_any_number_of_cores(spark, tmp_path):
    """The scan packs large files first; the order of the names decides all the same."""
    for name, n in (("a", 20), ("b", 5000)):
        (tmp_path / f"{name}.csv").write_text("id,file\n" + "".join(f"{i},{name}\n" for i in range(n)))
    contract = TableContract("t", "id", rules=[Unique(("id",))])
    for cores in ("1", "8"):
        spark.conf.set("spark.sql.files.minPartitionNum", cores)
        tagged = tag_table(read_csv(spark, str(tmp_path)), contract, {})
        kept = tagged.where(F.col("rejection_reason").isNull())
        assert kept.where("file = 'a'").count() == 20 and kept.count() == 5000
    spark.conf.unset("spark.sql.files.minPartitionNum")


def test_a_rule_for_a_column_that_is_not_there_raises(spark):
    raw = spark.createDataFrame([("1", "x")], "Id string, `dose.mg` string")
    with pytest.raises(ValueError, match="no column 'gender'"):
        tag_table(raw, TableContract("t", "id", columns={"gender": F.upper}), {})
    contract = TableContract("t", "id", columns={"id": F.lower, "dose.mg": F.upper}, rules=[
        Required("null dose", "dose.mg"), Unique(("dose.mg",)), References("dose.mg", "p", "dose.mg"),
    ])
    tagged = tag_table(raw, contract, {"p": raw.select(F.upper("`dose.mg`").alias("dose.mg"))})
    assert tagged.first()["dose.mg"] == "X" and tagged.first()["rejection_reason"] is None


def test_circles_are_refused():
    a = TableContract("a", "k", rules=[References("k", "b")])
    b = TableContract("b", "k", rules=[References("k", "a")])
    with pytest.raises(ValueError, match="circle"):
        in_parent_order({"a": a, "b": b})


def test_command_line(spark, run, tmp_path, capsys):
    raw = tmp_path / "raw"
    for name, file in preset.SOURCE_FILES.items():
        read_csv(spark, run[1][name]).coalesce(1).write.csv(str(raw / file), header=True)
    common = ["--out", str(tmp_path / "out"), "--run-id", "r1", "--as-of", str(AS_OF)]
    assert main(["clean", "--source", str(raw), *common]) == 0
    assert main(["check", *common]) == 0
    assert main(["judge", *common]) == 0
    published = main(["publish", *common])
    text = capsys.readouterr().out
    assert (published == 0) == ("published" in text) and (published == 1) == ("blocked" in text)
