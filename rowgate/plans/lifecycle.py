"""From raw tables to a published fact: clean, check, judge, publish.

Clean and quarantined rows of a run are one version, committed at once with a manifest. The
report names the version it checked, the verdict the one that was judged, and only that one is
published.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, field
from datetime import date
from functools import reduce
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.names import own_name
from ..operators.checks import failures_by_table, fk_violations, row_counts, run_checks
from ..operators.enrich import Dimension, enrich
from ..operators.histogram import Axis, histograms
from ..operators.split import accounting, clean_rows
from ..operators.verdict import verdicts
from ..session import SETTINGS, settings, spread
from ..sources.buckets import largest_share, read_bucketed, write_bucketed
from ..sources.files import read_csv, read_parquet, write_split
from ..sources.ledger import record_run
from ..sources.reports import read_report, read_verdict, write_report, write_verdict
from ..sources.runs import aside
from ..sources.staging import StagingArea, file_system
from ..sources.versions import new_version, read_clean, read_manifest, read_unbucketed
from .contract import TableContract, in_parent_order, tag_table


T = TypeVar("T")
R = TypeVar("R")


class PublishBlocked(Exception):
    """The verdict does not allow publishing, or is about other data."""


def at_once(spark: SparkSession, work: Callable[[T], R], items: Sequence[T]) -> list[R]:
    """Apply ``work`` to all items from parallel threads, so that their jobs share the cluster."""
    run = inheritable_thread_target(spark)(work)
    with ThreadPoolExecutor(max_workers=len(items)) as pool:
        return list(pool.map(run, items))


def in_waves(
    spark: SparkSession,
    contracts: Mapping[str, TableContract],
    work: Callable[[TableContract, Mapping[str, DataFrame]], DataFrame],
    clean: Callable[[DataFrame], DataFrame],
) -> dict[str, DataFrame]:
    """Apply ``work`` to each contract and its parents' clean rows, parents first.

    Tables that do not wait for each other are worked on at the same time. A parent's clean
    rows are its accepted ones, so a rejected parent orphans its children.
    """
    done: dict[str, DataFrame] = {}
    for wave in in_parent_order(contracts):
        results = at_once(
            spark, lambda c: work(c, {name: clean(done[name]) for name in c.parents}), wave
        )
        done |= {contract.name: df for contract, df in zip(wave, results)}
    return {name: done[name] for name in contracts}


def tag_tables(
    raw: Mapping[str, DataFrame], contracts: Mapping[str, TableContract], area: StagingArea
) -> dict[str, DataFrame]:
    """Every table tagged; its rows are written once, and the reasons beside them."""

    def tag(contract: TableContract, parents: Mapping[str, DataFrame]) -> DataFrame:
        decided = tag_table(raw[contract.name], contract, parents, area)
        return area.stage(decided, f"{contract.name}-tagged") if contract.only_row_rules else decided

    return in_waves(area.spark, contracts, tag, clean_rows)


def account(tagged: Mapping[str, DataFrame]) -> DataFrame:
    """Rows in, cleaned and quarantined of every table."""
    return reduce(DataFrame.unionByName, (accounting(df, name) for name, df in tagged.items()))


@dataclass(frozen=True)
class Account:
    """Rows of one table that were read and written, as the jobs counted that read and wrote them."""

    table: str
    rows_in: int
    rows_cleaned: int
    rows_quarantined: int
    by_reason: Mapping[str, int] = field(default_factory=dict)


#: A key of so many times a bucket's even share of the rows is hot.
HOT = 2

# One open file per reason and task instead of a sort of whole rows by reason.
WRITERS = {"spark.sql.maxConcurrentOutputFileWriters": "64"}


def _dealt(buckets: int | None) -> dict[str, str]:
    """Shuffles deal rows as bucketed tables have them, so the tables stay where they are."""
    return {"spark.sql.shuffle.partitions": str(buckets)} if buckets else {}


def clean_stage(
    spark: SparkSession,
    contracts: Mapping[str, TableContract],
    sources: Mapping[str, str],
    cleaned_dir: str,
    quarantine_dir: str,
    run_id: str | None = None,
    as_of: date | None = None,
    buckets: int | None = None,
    **csv_options,
) -> list[Account]:
    """Read the raw files, write clean and quarantined rows per table, return the accounting.

    Each row is decided once: both sides of a table are written by one pass over its staged
    rows. Lines that have not as many fields as their file's header are quarantined as they
    stand. The job that reads a table counts its rows, the job that writes it those of each
    reason; nothing is read again to count. Both folders become the current version by one commit,
    with a manifest that names the run, its ``as_of`` and the counts; older versions stay
    until ``expire`` deletes them. Raises, and leaves the version before, if rows do not add
    up, have a reason that the contract does not know, or cannot be written.

    With ``buckets``, clean tables whose contract makes the key unique are dealt into so many
    files by it, by one more shuffle of their rows. Then neither foreign keys that refer to them, nor checks
    for repeated keys, nor the joins of the publish stage shuffle them again.
    """
    lines: dict[str, Account] = {}
    bucketed: dict[str, dict] = {}
    with (
        settings(spark, SETTINGS | WRITERS | _dealt(buckets)), StagingArea(spark) as area,
        new_version(spark, cleaned_dir, quarantine_dir) as version,
    ):
        cleaned_new, quarantine_new = version.paths

        def clean(contract: TableContract, parents: Mapping[str, DataFrame]) -> DataFrame:
            name, part, seen = contract.name, area.part(contract.name), Observation()
            raw = spread(read_csv(spark, sources[name], malformed="mark", positions=True, **csv_options))
            raw = raw.observe(seen, F.count(F.lit(1)).alias("rows"))
            tagged = tag_table(raw, contract, parents, part)
            path, deal = f"{cleaned_new}/{name}", buckets and contract.has_unique_key
            first = f"{cleaned_new}/{name}-undealt" if deal else path
            counts = write_split(tagged, first, f"{quarantine_new}/{name}", contract.reasons)
            line = Account(name, seen.get["rows"], counts.accepted, counts.rejected, counts.by_reason)
            if line.rows_in != counts.rows:
                raise RuntimeError(f"rows do not add up: {line}")
            lines[name] = line
            if not deal:
                return read_parquet(spark, path)
            rows = read_parquet(spark, first)
            key = own_name(rows, contract.key)
            write_bucketed(rows, path, key, buckets)
            fs, folder = file_system(spark, first)
            fs.delete(folder, True)
            bucketed[name] = {"key": key, "schema": rows.schema.jsonValue()}
            return read_bucketed(spark, path, rows.schema, key, buckets)

        in_waves(spark, contracts, clean, lambda df: df)
        version.commit(
            {
                "run_id": run_id, "as_of": as_of and as_of.isoformat(),
                "tables": [asdict(lines[name]) for name in contracts],
                **({"buckets": buckets, "bucketed": bucketed} if bucketed else {}),
            }
        )
    return [lines[name] for name in contracts]


def _manifest(spark: SparkSession, cleaned_dir: str, run_id: str) -> dict:
    """The manifest of the clean tables, which must be of this run if they name one."""
    manifest = read_manifest(spark, cleaned_dir)
    if manifest.get("run_id") not in (None, run_id):
        raise ValueError(f"{cleaned_dir} was cleaned by run {manifest['run_id']}, not {run_id}")
    return manifest


def check_stage(
    spark: SparkSession,
    contracts: Mapping[str, TableContract],
    cleaned_dir: str,
    report_path: str,
    run_id: str,
    charts_path: str | None = None,
    axes: Sequence[Axis] = (),
    ledger_path: str | None = None,
    checked_at: str | None = None,
) -> DataFrame:
    """Run every check on the clean tables and write the report.

    With ``ledger_path``, the results are also added to the ledger of runs there, at
    ``checked_at`` (ISO text; by default the run id), so that ``with_drift`` and
    ``verdict_history`` can compare runs.

    With ``charts_path``, the numbers behind the charts are written there too, as one Parquet
    table each: ``row_counts``, ``failures_by_table``, ``fk_violations`` and, if there are
    ``axes``, ``histograms``.
    """
    manifest = _manifest(spark, cleaned_dir, run_id)
    with settings(spark, SETTINGS | _dealt(manifest.get("buckets"))), StagingArea(spark) as area:
        tables = {name: read_clean(spark, cleaned_dir, name, manifest.get("version")) for name in contracts}
        suites = [c.suite for c in contracts.values()]
        results = area.stage(run_checks(tables, suites, run_id, area=area), "results")
        if charts_path:
            with aside(spark, charts_path) as new:
                for name, chart in _charts(results, tables, axes).items():
                    chart.write.parquet(f"{new.path}/{name}")
                new.swap()
        write_report(results, report_path, manifest.get("version"))
        if ledger_path:
            record_run(results, ledger_path, checked_at or run_id, manifest.get("version"))
    return read_report(spark, report_path)[0]


def _charts(results: DataFrame, tables: Mapping[str, DataFrame], axes: Sequence[Axis]) -> dict[str, DataFrame]:
    # One row per check, table or bin.
    charts = {
        "row_counts": row_counts(results), "failures_by_table": failures_by_table(results),
        "fk_violations": fk_violations(results),
    }
    if axes:
        charts["histograms"] = histograms(tables, list(axes))
    return {name: chart.coalesce(1) for name, chart in charts.items()}


def judge_stage(spark: SparkSession, report_path: str, verdict_path: str, judged_at: str) -> DataFrame:
    """Judge the written report and write the verdict, with the version of the data it is about."""
    results, overall = read_report(spark, report_path)
    version = overall.select("run_id", "data_version")
    write_verdict(verdicts(results, overall).join(version, "run_id"), verdict_path, judged_at)
    return read_verdict(spark, verdict_path)


def may_publish(verdict: DataFrame, run_id: str, version: str | None = None) -> bool:
    """Whether this very run, and this version of its data, was judged fit; no verdict is a no."""
    mine = verdict.where((F.col("run_id") == run_id) & F.col("publish"))
    if "data_version" in verdict.columns:
        mine = mine.where(F.col("data_version").eqNullSafe(F.lit(version).cast("string")))
    elif version is not None:
        return False
    return not mine.isEmpty()


def publish_if(
    verdict: DataFrame,
    run_id: str,
    fact: DataFrame,
    gold: DataFrame,
    path: str,
    version: str | None = None,
    unchanged: Callable[[], bool] = lambda: True,
    versioned: bool = False,
) -> int:
    """Write ``gold`` if the verdict of the run allows it, else raise and write nothing.

    The joins run into a folder beside ``path``, and the rows that they write, counted by the
    job itself, are compared with the fact's; then it takes the place of ``path``. So neither a failed
    write nor a dimension with repeated keys reaches readers. ``unchanged`` says, when all is
    read, whether the data still is the version that was judged.

    ``versioned`` commits the folder as the current version of ``path`` instead, with the
    run, the version of the data and the rows in its manifest; ``read_version`` reads it.
    """
    spark = gold.sparkSession
    if not may_publish(verdict, run_id, version):
        if may_publish(verdict.drop("data_version"), run_id):
            raise PublishBlocked(f"the data was cleaned again after run {run_id} was judged")
        summaries = [r["summary"] for r in verdict.where(F.col("run_id") == run_id).collect()]
        raise PublishBlocked("; ".join(summaries) or f"no verdict for run {run_id}")
    with new_version(spark, path) if versioned else aside(spark, path) as new:
        seen = Observation()
        watched = gold.observe(seen, F.count(F.lit(1)).alias("rows"))
        watched.write.parquet(new.paths[0] if versioned else new.path)
        rows_in, rows_out = fact.count(), seen.get["rows"]
        if not unchanged():
            raise PublishBlocked(f"the data was cleaned again while run {run_id} was published")
        if rows_in != rows_out:
            raise RuntimeError(f"the joins turned {rows_in} rows into {rows_out}")
        if versioned:
            new.commit({"run_id": run_id, "data_version": version, "rows": rows_out})
        else:
            new.swap()
    return rows_out


def publish_stage(
    spark: SparkSession,
    fact: str,
    dimensions: Sequence[Dimension],
    cleaned_dir: str,
    verdict_path: str,
    gold_path: str,
    run_id: str,
    versioned: bool = False,
) -> int:
    """Join the clean fact with its dimensions and publish it if the verdict is about these rows.

    ``versioned`` keeps the published tables of earlier runs, as ``publish_if`` says.

    A bucketed dimension is joined where it lies, unless one of its keys, or NULL, has more than a bucket's
    share of the fact's rows: those rows would meet in one task. Then the dimension is shuffled
    with the fact, and adaptive execution splits the key.
    """
    manifest = read_manifest(spark, cleaned_dir)
    version, buckets, bucketed = (manifest.get(k) for k in ("version", "buckets", "bucketed"))
    tables = {name: read_clean(spark, cleaned_dir, name, version) for name in [fact, *(d.table for d in dimensions)]}
    for d in dimensions:
        in_place = bucketed and d.table in bucketed and bucketed[d.table]["key"].lower() == d.key.lower()
        if not in_place or largest_share(tables[fact], d.key) * buckets > HOT:
            tables[d.table] = read_unbucketed(spark, cleaned_dir, d.table, version)
    gold = enrich(tables[fact], tables, dimensions)

    def unchanged() -> bool:
        return read_manifest(spark, cleaned_dir).get("version") == version

    verdict = read_verdict(spark, verdict_path)
    with settings(spark, _dealt(buckets)):
        return publish_if(verdict, run_id, tables[fact], gold, gold_path, version, unchanged, versioned)
