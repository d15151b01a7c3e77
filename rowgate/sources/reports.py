"""The quality report and the verdict as JSON.

A report holds one entry per declared check and a verdict one line per finding, so each
is one small row; ``coalesce(1)`` writes it as one file in the given folder.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .runs import aside

_REPORT = (
    "struct<run_timestamp: string, overall_pass: boolean, tables: map<string, struct<"
    "row_count: bigint, checks: map<string, struct<"
    "pass: boolean, count: bigint, sample_ids_masked: array<string>>>>>, data_version: string>"
)
_VERDICT = (
    "struct<publish: boolean, summary: string, root_causes: array<string>, "
    "recommendations: array<string>, agent_timestamp: string, report_run_timestamp: string, "
    "data_version: string>"
)


def _entries(key: str, value: Column) -> Column:
    """A map in the order of ``ord`` from grouped rows."""
    rows = F.collect_list(F.struct("ord", F.col(key).alias("k"), value.alias("v")))
    rows = F.array_sort(rows, lambda a, b: (a["ord"] - b["ord"]).cast("int"))
    return F.map_from_entries(F.transform(rows, lambda r: F.struct(r["k"], r["v"])))


def report_json(results: DataFrame, version: str | None = None) -> DataFrame:
    """One row ``(run_id, value)`` per run: the nested report as JSON text.

    ``version`` names the data that was checked; without one the report has no such entry.
    """
    outcome = F.struct(
        F.col("pass"),
        F.col("fail_count").alias("count"),
        F.col("sample_ids").alias("sample_ids_masked"),
    )
    by_table = results.groupBy("run_id", "table").agg(
        F.min("ord").alias("first"),
        F.max("row_count").alias("row_count"),
        _entries("check", outcome).alias("checks"),
        F.bool_and("pass").alias("pass"),
    )
    body = F.struct("row_count", "checks")
    return (
        by_table.withColumnRenamed("first", "ord")
        .groupBy("run_id")
        .agg(_entries("table", body).alias("tables"), F.bool_and("pass").alias("overall_pass"))
        .select(
            "run_id",
            F.to_json(
                F.struct(
                    F.col("run_id").alias("run_timestamp"), "overall_pass", "tables",
                    F.lit(version).cast("string").alias("data_version"),
                )
            ).alias("value"),
        )
    )


def verdict_json(verdict: DataFrame, judged_at: str) -> DataFrame:
    """One row ``(run_id, value)`` per run: the verdict as JSON text."""
    fields = F.struct(
        "publish",
        "summary",
        "root_causes",
        "recommendations",
        F.lit(judged_at).alias("agent_timestamp"),
        F.col("run_id").alias("report_run_timestamp"),
        (F.col("data_version") if "data_version" in verdict.columns else F.lit(None).cast("string")).alias("data_version"),
    )
    return verdict.select("run_id", F.to_json(fields).alias("value"))


def _write_text(values: DataFrame, path: str) -> None:
    with aside(values.sparkSession, path) as new:
        values.select("value").coalesce(1).write.text(new.path)
        new.swap()


def write_report(results: DataFrame, path: str, version: str | None = None) -> None:
    _write_text(report_json(results, version), path)


def write_verdict(verdict: DataFrame, path: str, judged_at: str) -> None:
    _write_text(verdict_json(verdict, judged_at), path)


def _read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        text = spark.read.text(path, wholetext=True)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(path) from e
        raise
    return text.select(F.from_json("value", schema, {"mode": "FAILFAST"}).alias("j")).select("j.*")


def read_report(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Check results and the stored (run_id, overall_pass, data_version) of a report file or folder."""
    report = _read_json(spark, path, _REPORT).withColumn(
        "run_id", F.coalesce("run_timestamp", F.lit("unknown"))
    )
    tables = report.select("run_id", F.posexplode("tables").alias("t", "table", "body"))
    checks = tables.select(
        "run_id", "t", "table", "body.row_count", F.posexplode("body.checks").alias("c", "check", "r")
    )
    results = checks.select(
        "run_id",
        "table",
        "check",
        (F.row_number().over(Window.partitionBy("run_id").orderBy("t", "c")) - 1).alias("ord"),
        F.lit(None).cast("string").alias("kind"),
        "row_count",
        F.col("r.count").alias("fail_count"),
        F.col("r.pass").alias("pass"),
        F.col("r.sample_ids_masked").alias("sample_ids"),
    )
    return results, report.select("run_id", "overall_pass", "data_version")


def read_verdict(spark: SparkSession, path: str) -> DataFrame:
    """A stored verdict; a missing ``publish`` reads as false."""
    verdict = _read_json(spark, path, _VERDICT)
    return verdict.select(
        F.col("report_run_timestamp").alias("run_id"),
        F.coalesce("publish", F.lit(False)).alias("publish"),
        "summary",
        "root_causes",
        "recommendations",
        "data_version",
    )
