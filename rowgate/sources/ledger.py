"""The ledger of runs: the check results of every run, kept beside those of the others."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .staging import file_system

_SCHEMA = (
    "`table` string, `check` string, ord int, kind string, row_count bigint, fail_count bigint, pass boolean, "
    "sample_ids array<string>, data_version string, recorded_at string, run_id string"
)


def record_run(results: DataFrame, path: str, recorded_at: str, version: str | None = None) -> None:
    """Add the check results of a run to the ledger; a run that is recorded again replaces itself only.

    ``results`` are those of ``run_checks``, one row per declared check, also of several
    runs. ``recorded_at`` says, as ISO text, where the run stands among the others. The ledger is
    partitioned by run, so no other run is read or written.
    """
    known = {c: F.col(f"`{c}`") for c in results.columns}
    rows = results.withColumns(
        {"data_version": F.lit(version).cast("string"), "recorded_at": F.lit(recorded_at).cast("string")}
    ).withColumn("ord", F.col("ord").cast("int"))
    if "kind" not in known:
        rows = rows.withColumn("kind", F.lit(None).cast("string"))
    (
        rows.repartition("run_id").write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(path)
    )


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """All recorded runs; none if the ledger is not there yet."""
    fs, folder = file_system(spark, path)
    if not fs.exists(folder):
        return spark.createDataFrame([], _SCHEMA)
    return spark.read.schema(_SCHEMA).parquet(path)
