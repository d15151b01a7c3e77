"""Check results of many runs: how each check has changed since the run before."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .verdict import failures, verdicts


def _share(fail_count: Column, row_count: Column) -> Column:
    return F.try_divide(fail_count.cast("double"), row_count.cast("double"))


def with_drift(history: DataFrame) -> DataFrame:
    """Every result of a ledger with its check's result in the run before.

    Adds ``previous_run``, ``previous_count``, ``previous_share``, ``drift`` (share of
    failing rows now minus then, NULL without a run before) and ``change``: ``new`` for the first
    result of a check, ``broken`` and ``fixed`` where the outcome turned, else ``worse``,
    ``better`` or ``same`` by the share. Runs are ordered by when they were recorded, then by
    id. A missing outcome counts as failed. A check that one run leaves out is compared with
    the last run that has it. A window holds the runs of one check.
    """
    history = history.withColumn("share", _share(F.col("fail_count"), F.col("row_count")))
    before = Window.partitionBy("table", "check").orderBy("recorded_at", "run_id")
    passed = F.coalesce("pass", F.lit(False))
    compared = history.withColumns(
        {
            "previous_run": F.lag("run_id").over(before), "previous_count": F.lag("fail_count").over(before),
            "previous_share": F.lag("share").over(before), "previous_pass": F.lag(passed).over(before),
        }
    )
    drift = F.col("share") - F.col("previous_share")
    change = (
        F.when(F.col("previous_run").isNull(), "new")
        .when(F.col("previous_pass") & ~passed, "broken")
        .when(~F.col("previous_pass") & passed, "fixed")
        .when(drift > 0, "worse").when(drift < 0, "better").otherwise("same")
    )
    return compared.withColumns({"drift": drift, "change": change}).drop("previous_pass", "share")


def verdict_history(history: DataFrame) -> DataFrame:
    """One row per run: its verdict, how many checks failed, and how many changed since the run before.

    ``largest_drift`` is the greatest rise of a check's share of failing rows.
    """
    drifts = with_drift(history)
    changes = drifts.groupBy("run_id").agg(
        F.max("recorded_at").alias("recorded_at"), F.max("data_version").alias("data_version"),
        F.count(F.lit(1)).alias("checks"),
        *(F.count_if(F.col("change") == kind).alias(kind) for kind in ("broken", "fixed", "worse", "better")),
        F.max("drift").alias("largest_drift"),
    )
    failed = failures(history).groupBy("run_id").agg(
        F.count(F.lit(1)).alias("failed"), F.count_if(F.col("severity") == "CRITICAL").alias("critical")
    )
    judged = verdicts(history).select("run_id", "publish", "summary")
    return (
        changes.join(judged, "run_id").join(failed, "run_id", "left").fillna(0, ["failed", "critical"])
        .select(
            "run_id", "recorded_at", "data_version", "publish", "summary", "checks", "failed", "critical",
            "broken", "fixed", "worse", "better", "largest_drift",
        )
    )
