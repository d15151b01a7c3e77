"""Plans that hold for large tables: what is read, shuffled, split and broadcast."""

import os
import time
from glob import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from rowgate.operators.checks import HasParent, NotNull, Suite, UniqueKey, _count_table
from rowgate.operators.decisions import PART, ROW, stage_rows
from rowgate.operators.duplicates import later_copies, tag_duplicates
from rowgate.operators.enrich import Dimension, enrich
from rowgate.operators.outliers import tag_outliers
from rowgate.operators.references import orphan_keys, orphan_rows, tag_orphans
from rowgate.operators.rules import Required, Within, untagged
from rowgate.plans.contract import NotOutlying, References, TableContract, Unique, tag_table
from rowgate.plans.lifecycle import WRITERS, tag_tables
from rowgate.session import SETTINGS, settings, spread
from rowgate.sources import StagingArea, read_quarantine, staging, write_split


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(name="change")
def change_settings(spark):
    """Set session settings for one test."""
    before = {}

    def change(**values):
        for name, value in values.items():
            name = "spark.sql." + name.replace("__", ".")
            before.setdefault(name, spark.conf.get(name))
            spark.conf.set(name, value)

    yield change
    for name, value in before.items():
        spark.conf.set(name, value)


@pytest.fixture
def no_broadcast_and_small_partitions(change):
    change(
        autoBroadcastJoinThreshold="-1",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="64k",
        adaptive__advisoryPartitionSizeInBytes="32k",
    )


@pytest.fixture(scope="module")
def hot(spark, tmp_path_factory):
    """A third of the rows share one key, a third has none."""
    path = str(tmp_path_factory.mktemp("hot") / "rows")
    spark.range(0, 300000, 1, 8).selectExpr(
        "id as k", "case id % 3 when 0 then 'hot' when 1 then concat('k', id div 6) end as key",
        "cast(id * 7919 % 1000 as double) as v", "repeat(md5(cast(id as string)), 2) as payload",
    ).write.parquet(path)
    return spark.read.parquet(path)


def test_a_hot_key_is_split_when_rows_are_shuffled(
    spark, hot, no_broadcast_and_small_partitions
):
    parents = hot.where("key like 'k%'").select("key").distinct()
    names = hot.select("key").distinct().withColumn("name", F.upper("key"))
    dimension = {"d": StagingArea(spark).stage(names, "names")}
    for tagged in (
        tag_duplicates(hot, "key"),
        tag_orphans(hot, "key", parents, "orphan"),
        enrich(hot, dimension, [Dimension("d", "key", {"name": "n"})]),
    ):
        assert len(tagged.collect()) == 300000
        assert "skew=true" in plan(tagged)


def test_rows_are_not_shuffled_while_the_key_lists_are_small(spark, hot):
    parents = spark.createDataFrame([("hot",)], "key string")
    few = hot.withColumn("key", F.when(F.col("k") % 50000 == 0, "twice").otherwise(F.col("k").cast("string")))
    assert "Exchange hashpartitioning" not in plan(tag_duplicates(few, "key"))
    known = few.where("key <> 'twice'").select("key").union(parents)
    assert "Exchange hashpartitioning" not in plan(tag_orphans(few, "key", known, "orphan"))
    assert "Exchange" not in plan(tag_outliers(hot, "v"))


#: Every rule that needs the whole table, with rules for single rows before, between and after them.
WIDE = TableContract(
    "rows", "key",
    rules=[
        Required("no key", "key"), Unique(("key",), ("k",)), Within("high", {"v": (0.0, 990.0)}),
        NotOutlying(("v",), 1.5), References("key", "parents"), Within("low", {"v": (10.0, 1e9)}),
    ],
)


def _parents(hot):
    return hot.where("k % 7 < 2 and key is not null").select("key").distinct()


def test_wide_rows_stay_where_they_were_written(spark, hot, change):
    change(autoBroadcastJoinThreshold="-1")
    area = StagingArea(spark)
    with settings(spark, SETTINGS):
        tagged = tag_table(hot, WIDE, {"parents": _parents(hot)}, area)
        shuffles = plan(tagged).split("Exchange hashpartitioning(")[1:]
        assert len(shuffles) == 1 and "payload" not in plan(tagged).partition("Exchange ")[2]
        assert "Sort " not in plan(tagged)
    written = [name for name, df in area.tables.items() if "payload" in df.columns]
    assert written == []  # but for the rows themselves, which the plan reads


def test_tables_of_row_rules_are_written_once_all_others_with_their_rows(spark, hot):
    area = StagingArea(spark)
    plain = TableContract("plain", "key", rules=[Required("no key", "key")])
    tag_tables({"rows": hot, "parents": _parents(hot), "plain": hot},
               {"rows": WIDE, "parents": TableContract("parents", "key"), "plain": plain}, area)
    assert {"plain-tagged", "parents-tagged", "reasons"} <= area.tables.keys() and "rows-tagged" not in area.tables


@pytest.mark.parametrize("limit", ["-1", "10MB"])
@pytest.mark.parametrize("tuned", [False, True])
def test_staged_reasons_are_those_of_the_rules_in_order(spark, hot, change, limit, tuned):
    """Odd names, null and hot keys: the reasons are those that the rules give one after another."""
    change(autoBroadcastJoinThreshold=limit)
    odd = hot.withColumn("a, b.`c", F.upper("payload"))
    with settings(spark, SETTINGS if tuned else {}):
        tagged = tag_table(odd, WIDE, {"parents": _parents(hot)})
        assert tagged.columns == ["k", "key", "v", "payload", "a, b.`c", "_position", "rejection_reason"]
        found = {r["k"]: (r["rejection_reason"], r["payload"], r[4]) for r in tagged.collect()}
        rows, known = hot.collect(), {r["key"] for r in _parents(hot).collect()}
    assert len(found) == len(rows) == 300000
    reasons, first = {}, set()
    for r in sorted(rows, key=lambda r: r["k"]):
        reasons[r["k"]] = "no key" if r["key"] is None else "duplicate primary key" if r["key"] in first else "high" if r["v"] > 990 else None
        first.add(r["key"])
    left = [r for r in rows if reasons[r["k"]] is None]
    mean = sum(r["v"] for r in left) / len(left)
    sd = (sum((r["v"] - mean) ** 2 for r in left) / (len(left) - 1)) ** 0.5
    for r in left:
        reasons[r["k"]] = (
            "zscore_outlier_v" if abs(r["v"] - mean) > 1.5 * sd
            else "fk_key not in parents" if r["key"] not in known else "low" if r["v"] < 10 else None
        )
    assert all(found[r["k"]] == (reasons[r["k"]], r["payload"], r["payload"].upper()) for r in rows)
    assert set(reasons.values()) >= {"no key", "duplicate primary key", "high", "zscore_outlier_v", "fk_key not in parents", None}


def test_keys_are_combined_before_the_shuffle(spark, hot, change):
    change(autoBroadcastJoinThreshold="-1")
    for text in (
        plan(orphan_keys(hot, "key", hot.select("key"), "key")),
        plan(_count_table(hot, Suite("t", "k", [HasParent("fk", "key", "t")]), {"t": hot})),
        plan(_count_table(hot, Suite("t", "k", [UniqueKey("duplicate_pk", "key")]), {})),
    ):
        before_shuffle = text.split("Exchange hashpartitioning(")[1]
        assert "HashAggregate(keys=[" in before_shuffle and "payload" not in text


def test_row_checks_of_a_table_are_one_scan_of_their_columns(spark, hot):
    suite = Suite("t", "k", [NotNull("null_k", "k"), NotNull("null_key", "key")])
    text = plan(_count_table(hot, suite, {}))
    assert text.count("FileScan") == 1 and "ReadSchema: struct<k:bigint,key:string>" in text


def test_both_sides_of_a_split_are_one_scan_of_the_rows(spark, hot, tmp_path, monkeypatch):
    """Clean and quarantined rows are written by one pass, without another sort or shuffle."""
    tagged = tag_duplicates(hot.select("k", "key", "v"), "key")
    written = []
    write = DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, *a, **o: (written.append(plan(self._df)), write(self, *a, **o)))
    with settings(spark, WRITERS):
        write_split(tagged, str(tmp_path / "clean"), str(tmp_path / "rejected"))
    assert len(written) == 1
    assert written[0].count("FileScan") == plan(tagged).count("FileScan")
    assert written[0].count("Exchange") == plan(tagged).count("Exchange") and "Sort " not in written[0]
    clean, rejected = spark.read.parquet(str(tmp_path / "clean")), spark.read.parquet(str(tmp_path / "rejected"))
    assert clean.columns == ["k", "key", "v"] and rejected.columns == ["k", "key", "v", "rejection_reason"]
    assert clean.count() + rejected.count() == 300000 and rejected.count() > 0


def test_a_split_without_rows_on_one_side_has_both_tables(spark, tmp_path):
    rows = spark.createDataFrame([(1, None), (2, None)], "k int, rejection_reason string")
    for name, tagged, kept in (("all", rows, 2), ("none", rows.withColumn("rejection_reason", F.lit("bad")), 0)):
        write_split(tagged, str(tmp_path / name / "clean"), str(tmp_path / name / "rejected"))
        clean = spark.read.parquet(str(tmp_path / name / "clean"))
        assert clean.columns == ["k"] and clean.count() == kept
        assert read_quarantine(spark, str(tmp_path / name / "rejected"), clean.schema).count() == 2 - kept


def test_settings_are_put_back(spark):
    name = "spark.sql.codegen.hugeMethodLimit"
    spark.conf.unset(name)
    before = spark.conf.get(name)
    with pytest.raises(RuntimeError), settings(spark, {name: "1234"}):
        assert spark.conf.get(name) == "1234"
        raise RuntimeError
    assert spark.conf.get(name) == before


def test_areas_are_removed_after_a_failure(spark, hot):
    with pytest.raises(RuntimeError), StagingArea(spark) as area:
        path = area.path
        area.stage(hot.limit(5), "rows")
        raise RuntimeError
    assert not os.path.exists(path.removeprefix("file:"))


def test_staging_areas_are_apart_and_removed(spark, hot):
    area, other = StagingArea(spark), StagingArea(spark)
    staged = area.part("t").stage(hot.limit(5), "rows")
    assert staged.count() == 5 and area.path != other.path
    area.remove()
    with pytest.raises(Exception, match="FILE|not exist|No such"):
        spark.read.parquet(staged.inputFiles()[0]).count()


def test_only_scans_of_few_partitions_are_spread(spark):
    cores = spark.sparkContext.defaultParallelism
    assert spread(spark.range(0, 100, 1, 1)).rdd.getNumPartitions() == cores
    assert spread(spark.range(0, 100, 1, cores)).rdd.getNumPartitions() == cores
    assert "Exchange" not in plan(spread(spark.range(0, 100, 1, cores)))


def test_partitioning_does_not_change_the_outcome(spark, hot, change):
    outcomes = []
    for partitions in ("3", "17"):
        change(shuffle__partitions=partitions)
        tagged = tag_outliers(tag_duplicates(hot, "key", ["v", "k"]), ["v"], threshold=1.5)
        outcomes.append(sorted(map(tuple, tagged.groupBy("rejection_reason").count().collect()), key=str))
    assert outcomes[0] == outcomes[1]


def test_staged_rows_fill_their_buckets_evenly(spark):
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)
    with settings(spark, SETTINGS):
        rows = stage_rows(untagged(spark.range(0, buckets << 16, 1, 4)), "rows", StagingArea(spark))
        sizes = rows.groupBy(F.pmod(F.hash(PART), F.lit(buckets)).alias("bucket")).count().collect()
    assert len(sizes) == min(buckets, 32) and max(r["count"] for r in sizes) <= 2 * min(r["count"] for r in sizes)
    assert rows.select(ROW).distinct().count() == buckets << 16


def test_parts_of_staged_rows_combine_their_keys_before_one_shuffle(spark, hot, change):
    """Neither copies nor orphans shuffle rows by their key: not in the plan, and not of a hot key."""
    change(autoBroadcastJoinThreshold="-1", adaptive__enabled="false")
    area, parents = StagingArea(spark), _parents(hot).where("key <> 'hot'")
    raw = untagged(hot).withColumn("_position", F.struct(F.col("k").alias("row")))
    with settings(spark, SETTINGS):
        rows = stage_rows(raw, "rows", area)
        copies = later_copies(rows, ["key"], ["v"])
        assert plan(copies).count("Exchange hashpartitioning(") == 1
        lost = orphan_rows(rows, "key", parents, area=area)
        shuffled = plan(lost).split("Exchange hashpartitioning(")
        assert len(shuffled) == 2 and "payload" not in plan(lost) and ROW not in shuffled[1].split("FileScan")[0]
        found = [{r["k"] for r in rows.join(df, [PART, ROW]).select("k").collect()} for df in (copies, lost)]
    tagged = [tag_duplicates(raw, "key", ["v"]), tag_orphans(raw, "key", parents, "orphan")]
    assert found == [{r["k"] for r in df.where("rejection_reason is not null").collect()} for df in tagged]
    assert area.tables["orphan-keys"].where("_orphan = 'hot'").count() == rows.select(PART).distinct().count()


def test_staged_rows_are_written_without_dictionaries(spark, hot):
    area = StagingArea(spark)
    with settings(spark, SETTINGS):
        stage_rows(untagged(hot), "rows", area)
    group = pq.ParquetFile(glob(f"{area.path}/rows-*/*.parquet")[0]).metadata.row_group(0)
    columns = [group.column(i) for i in range(group.num_columns)]
    assert not any(c.has_dictionary_page for c in columns) and {c.compression for c in columns} == {"ZSTD"}


def test_short_reasons_meet_rows_by_their_number_alone(spark, hot):
    """As one number, which a join finds faster than two."""
    raw = untagged(hot).withColumn("_position", F.struct(F.col("k").alias("row")))
    with settings(spark, SETTINGS):
        tagged = tag_table(raw, TableContract("t", "k", rules=[Unique(("k",)), NotOutlying(("v",), 1.5)]), {})
        assert "BroadcastHashJoin [_row#" in plan(tagged)
        assert tagged.count() == 300000


def test_keys_of_parents_are_found_without_reasons_of_other_rules(spark, hot):
    area, parents = StagingArea(spark), _parents(hot)
    with settings(spark, SETTINGS):
        rows = stage_rows(untagged(hot), "rows", area)
        left = rows.withColumn("rejection_reason", F.when(F.col("key") == "k5", F.lit("other")))
        lost = orphan_rows(left, "key", parents, area=area, staged=rows)
        assert area.tables["orphan-keys"].where("_orphan = 'k5'").count() > 0
        found = {r["k"] for r in rows.join(lost, [PART, ROW]).select("k").collect()}
        again = orphan_rows(left, "key", parents, area=area)
        assert found == {r["k"] for r in rows.join(again, [PART, ROW]).select("k").collect()}
    assert found and found.isdisjoint({31, 34})  # the rows of k5


def test_shuffle_files_of_staged_tables_are_deleted(spark, hot, monkeypatch):
    """By the next tables; else the disks hold those of all steps, as the driver rarely collects its garbage."""
    monkeypatch.setattr(staging, "RELEASE_EVERY", 0.0)
    folders = [str(f) for f in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]

    def shuffled() -> set[str]:
        return {name for top in folders for _, _, names in os.walk(top) for name in names if name.endswith(".data")}

    before = shuffled()
    area = StagingArea(spark)
    area.stage(hot.groupBy("key", "payload").agg(F.min("v").alias("v")), "counts")
    for _ in range(10):
        time.sleep(1)
        area.stage(spark.range(1), "next")
        if not shuffled() - before:
            break
    assert not shuffled() - before
