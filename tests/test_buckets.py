"""Clean tables that are bucketed by their keys: the same rows, and no shuffle of them afterwards."""

import os
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as book
from querybook.book import Tables
from querybook.clinical import AS_OF, FIRST_BY, MESSY
from rowgate.operators.checks import HasParent, Suite, UniqueKey, _count_table
from rowgate.operators.enrich import Dimension
from rowgate.operators.footers import footer_ranges, has_statistics
from rowgate.operators.references import orphan_keys
from rowgate.operators.rules import Required
from rowgate.plans import healthcare as preset
from rowgate.plans import lifecycle
from rowgate.plans.contract import References, TableContract, Unique
from rowgate.plans.lifecycle import check_stage, clean_stage, judge_stage, publish_stage
from rowgate.session import settings
from rowgate.sources import largest_share, read_bucketed, read_clean, read_manifest, read_parquet, read_unbucketed, write_bucketed

NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1"}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def shuffled_scans(text: str) -> list[str]:
    """For each scan of a plan, "bucketed" or "plain", and whether its rows go through an exchange of all of them."""
    found, above = [], []
    for line in text.splitlines():
        depth = len(re.match(r"[\s:+\-|]*", line).group())
        above = [(d, node) for d, node in above if d < depth]
        node = line[depth:]
        above.append((depth, node))
        if "FileScan" in node:
            kinds = ["agg" if "HashAggregate" in n else "exchange" if n.startswith("Exchange hash") else "" for _, n in above]
            whole = "exchange" in kinds and "agg" not in kinds[max(i for i, k in enumerate(kinds) if k == "exchange") :]
            found.append(f"{'bucketed' if 'Bucketed: true' in node else 'plain'}{' shuffled' if whole else ''}")
    return found


@pytest.fixture(scope="module")
def runs(spark, tmp_path_factory):
    """The preset's tables cleaned with and without buckets."""
    out = str(tmp_path_factory.mktemp("bucketed"))
    tables, contracts = Tables(spark, book.SMOKE_DIR), preset.healthcare(AS_OF, FIRST_BY)
    sources = {name: f"{out}/raw/{name}" for name in MESSY}
    for name, path in sources.items():
        MESSY[name](tables).repartition(3).write.csv(path, header=True)
    with settings(spark, NO_BROADCAST):
        plain = clean_stage(spark, contracts, sources, f"{out}/plain", f"{out}/plain-rejected", "r")
        dealt = clean_stage(spark, contracts, sources, f"{out}/dealt", f"{out}/dealt-rejected", "r", buckets=4)
    return out, contracts, plain, dealt


def test_the_same_rows_are_clean(spark, runs):
    out, contracts, plain, dealt = runs
    assert dealt == plain
    manifest = read_manifest(spark, f"{out}/dealt")
    assert manifest["buckets"] == 4 and set(manifest["bucketed"]) == set(contracts)
    for name in contracts:
        with_buckets, without = read_clean(spark, f"{out}/dealt", name), read_clean(spark, f"{out}/plain", name)
        assert with_buckets.schema == without.schema
        assert sorted(map(str, with_buckets.collect())) == sorted(map(str, without.collect()))
        files = [f for f in os.listdir(f"{out}/dealt/{manifest['version']}/{name}") if f.endswith(".parquet")]
        assert 0 < len(files) <= 4  # one per bucket that has rows
    assert not [t for t in os.listdir(f"{out}/dealt/{manifest['version']}") if "undealt" in t]
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("rowgate_")]


def test_checks_of_bucketed_tables_shuffle_no_bucketed_side(spark, runs):
    out, contracts, *_ = runs
    with settings(spark, NO_BROADCAST | {"spark.sql.shuffle.partitions": "4"}):
        tables = {name: read_clean(spark, f"{out}/dealt", name) for name in contracts}
        keys = _count_table(tables["patients"], Suite("p", "patient_id", [UniqueKey("duplicate_pk", "patient_id")]), tables)
        scans = shuffled_scans(plan(keys))
        assert "bucketed" in scans and "Exchange hashpartitioning" not in plan(keys)
        foreign = Suite("e", "encounter_id", [HasParent("fk", "patient_id", "patients")])
        for frame in (
            _count_table(tables["encounters"], foreign, tables),
            orphan_keys(tables["encounters"], "patient_id", tables["patients"], "patient_id"),
        ):
            text = plan(frame)
            assert text.count("Exchange hashpartitioning") == 1  # the keys that are used, combined before
            assert "bucketed" in shuffled_scans(text) and "bucketed shuffled" not in shuffled_scans(text)


def test_reports_and_verdicts_are_the_same(spark, runs):
    out, contracts, *_ = runs
    found = []
    for name in ("plain", "dealt"):
        check_stage(spark, contracts, f"{out}/{name}", f"{out}/{name}-report", "r")
        judge_stage(spark, f"{out}/{name}-report", f"{out}/{name}-verdict", "now")
        results = lifecycle.read_report(spark, f"{out}/{name}-report")[0]
        found.append(sorted(map(str, results.select("table", "check", "row_count", "fail_count", "pass", "sample_ids").collect())))
    assert found[0] == found[1] and found[0]


ONCE = [UniqueKey("duplicate_pk", "fid")]
PARENTS = TableContract("parents", "pid", rules=[Required("null pid", "pid"), Unique(("pid",))])
FACTS = TableContract("facts", "fid", rules=[Unique(("fid",)), References("pid", "parents")], checks=ONCE)


def published(spark, out, monkeypatch, hot, nullable=False):
    """The plan of the published join and its rows, where every ``hot``-th row does not have the one hot key."""
    facts = TableContract("facts", "fid", rules=[Unique(("fid",))], checks=ONCE) if nullable else FACTS
    contracts = {"parents": PARENTS, "facts": facts}
    hot_key = "cast(null as string)" if nullable else "'7'"
    spark.range(100).selectExpr("cast(id as string) as pid", "concat('n', id) as name").write.csv(f"{out}/raw/parents", header=True)
    spark.range(3000).selectExpr(
        "cast(id as string) as fid", f"if(id % 10 < {hot}, {hot_key}, cast(id % 100 as string)) as pid"
    ).write.csv(f"{out}/raw/facts", header=True)
    sources = {name: f"{out}/raw/{name}" for name in contracts}
    plans = []
    whole = lifecycle.publish_if

    def spy(verdict, run_id, fact, gold, *rest):
        plans.append(shuffled_scans(plan(gold)))
        return whole(verdict, run_id, fact, gold, *rest)

    monkeypatch.setattr(lifecycle, "publish_if", spy)
    with settings(spark, NO_BROADCAST):
        clean_stage(spark, contracts, sources, f"{out}/cleaned", f"{out}/quarantine", "r", buckets=8)
        check_stage(spark, contracts, f"{out}/cleaned", f"{out}/report", "r")
        judge_stage(spark, f"{out}/report", f"{out}/verdict", "now")
        publish_stage(
            spark, "facts", [Dimension("parents", "pid", {"name": "name"})], f"{out}/cleaned", f"{out}/verdict", f"{out}/gold", "r"
        )
    return plans[0], read_parquet(spark, f"{out}/gold")


def test_dimensions_are_joined_where_they_lie(spark, tmp_path, monkeypatch):
    scans, gold = published(spark, tmp_path, monkeypatch, hot=0)
    assert scans[-1] == "bucketed" and scans[0].endswith("shuffled")
    assert gold.count() == 3000 and gold.where("name = concat('n', pid)").count() == 3000


@pytest.mark.parametrize("nullable", [False, True])
def test_a_hot_key_is_not_left_to_one_bucket(spark, tmp_path, monkeypatch, nullable):
    scans, gold = published(spark, tmp_path, monkeypatch, hot=4, nullable=nullable)
    assert scans[-1] == "plain shuffled"  # both sides are, so adaptive execution can split
    assert gold.count() == 3000 and gold.where("name = concat('n', pid)").count() == (1800 if nullable else 3000)


def test_tables_whose_key_may_repeat_are_not_bucketed(spark, tmp_path):
    spark.range(50).selectExpr("'1' as id", "id as v").write.csv(f"{tmp_path}/raw", header=True)
    contract = TableContract("t", "id", rules=[Required("null v", "v")])
    clean_stage(spark, {"t": contract}, {"t": f"{tmp_path}/raw"}, f"{tmp_path}/c", f"{tmp_path}/q", "r", buckets=4)
    assert "buckets" not in read_manifest(spark, f"{tmp_path}/c")
    assert read_clean(spark, f"{tmp_path}/c", "t").count() == 50


def test_odd_names_and_empty_tables(spark, tmp_path):
    for n, folder in ((0, "none"), (200, "it's `odd`")):
        rows = spark.range(n).selectExpr("cast(id as string) as `my.Key`", "cast(id as double) as `a b`")
        path = f"{tmp_path}/{folder}"
        write_bucketed(rows, path, "my.key", 4)
        back = read_bucketed(spark, path, rows.schema, "my.Key", 4)
        assert back.columns == rows.columns and back.count() == n == back.select("`my.Key`").distinct().count()
        grouped = back.groupBy("`my.Key`").count()
        assert "Exchange" not in plan(grouped) and grouped.where("count > 1").isEmpty()
    assert has_statistics(back) and footer_ranges(back, ["a b"]) == [(0.0, 199.0)]


def test_a_clean_table_without_rows_is_there(spark, tmp_path):
    spark.createDataFrame([("1", None)], "id string, v string").write.csv(f"{tmp_path}/raw", header=True)
    contract = TableContract("t", "id", rules=[Required("null v", "v"), Unique(("id",))])
    (line,) = clean_stage(spark, {"t": contract}, {"t": f"{tmp_path}/raw"}, f"{tmp_path}/c", f"{tmp_path}/q", "r", buckets=4)
    assert (line.rows_cleaned, line.rows_quarantined) == (0, 1)
    assert read_clean(spark, f"{tmp_path}/c", "t").count() == 0


def test_rows_may_be_read_without_their_buckets(spark, runs):
    out, *_ = runs
    rows = read_unbucketed(spark, f"{out}/dealt", "patients")
    assert rows.count() == read_clean(spark, f"{out}/dealt", "patients").count()
    assert "Bucketed: true" not in plan(rows.groupBy("patient_id").count())


def test_the_largest_share_counts_nulls(spark):
    rows = spark.createDataFrame([("a",), (None,), (None,), ("b",)], "k string")
    assert largest_share(rows, "k") == 0.5 and largest_share(rows.where("false"), "k") == 0.0
    assert largest_share(rows.where(F.col("k").isNotNull()), "k") == 0.5
