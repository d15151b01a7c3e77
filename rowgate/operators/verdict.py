"""From check results to a publish verdict, for any number of runs at once."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fixed
from ..functions.text import percent_text


def is_critical(check: Column, fail_count: Column, row_count: Column) -> Column:
    """Critical by name, or because more than 5% of the table fails."""
    named = check.isin(*fixed.CRITICAL_CHECKS)
    prefixed = reduce(or_, (check.startswith(p) for p in fixed.CRITICAL_PREFIXES))
    share = F.try_divide(fail_count.cast("double"), row_count.cast("double"))
    return named | prefixed | F.coalesce(share > fixed.CRITICAL_SHARE, F.lit(False))


def failures(results: DataFrame) -> DataFrame:
    """Failed checks with severity, cause and advice.

    A missing outcome counts as failed, missing counts as zero.
    """
    check = F.col("check")
    count = F.coalesce("fail_count", F.lit(0))
    rows = F.coalesce("row_count", F.lit(0))
    label = F.concat_ws(".", "table", "check")
    share = percent_text(count, rows)
    why = (
        F.when(check.startswith("null_"), fixed.WHY_NULL)
        .when(check == "duplicate_pk", fixed.WHY_DUPLICATE)
        .when(check.startswith("fk_"), fixed.WHY_ORPHAN)
        .when(check == "icd10_format", fixed.WHY_PATTERN)
        .otherwise(F.format_string(fixed.WHY_SHARE, share))
    )
    critical = is_critical(check, count, rows)
    return results.where(~F.coalesce("pass", F.lit(False))).select(
        "run_id",
        "table",
        "check",
        "ord",
        F.when(critical, "CRITICAL").otherwise("MINOR").alias("severity"),
        F.when(critical, F.format_string(fixed.CRITICAL_CAUSE, label, count, share, why))
        .otherwise(F.format_string(fixed.MINOR_CAUSE, label, count))
        .alias("root_cause"),
        F.when(critical, F.format_string(fixed.CRITICAL_ADVICE, label))
        .otherwise(F.format_string(fixed.MINOR_ADVICE, label))
        .alias("recommendation"),
    )


def verdicts(results: DataFrame, overall: DataFrame | None = None) -> DataFrame:
    """One verdict per run: publish, summary, causes and advice, critical ones first.

    A run has one row per declared check, so the lists are short. ``overall`` (run_id,
    overall_pass) overrides what the rows say, as a stored report may.
    """
    rows = F.struct(
        (F.col("severity") == "MINOR").alias("minor"), "ord", "root_cause", "recommendation"
    )
    found = failures(results).groupBy("run_id").agg(
        F.count_if(F.col("severity") == "CRITICAL").alias("critical"),
        F.count_if(F.col("severity") == "MINOR").alias("minor"),
        F.array_sort(F.collect_list(rows)).alias("found"),
    )
    if overall is None:
        runs = results.groupBy("run_id").agg(
            F.bool_and(F.coalesce("pass", F.lit(False))).alias("overall_pass")
        )
    else:
        runs = overall.select("run_id", F.coalesce("overall_pass", F.lit(False)).alias("overall_pass"))
    critical, minor = F.coalesce("critical", F.lit(0)), F.coalesce("minor", F.lit(0))
    summary = (
        F.when(F.col("overall_pass"), fixed.SUMMARY_OVERALL_PASS)
        .when(critical > 0, F.format_string(fixed.SUMMARY_CRITICAL, critical))
        .when(minor > 0, F.format_string(fixed.SUMMARY_MINOR, minor))
        .otherwise(fixed.SUMMARY_NOTHING_FAILED)
    )

    def listed(field: str) -> Column:
        none = F.array().cast("array<string>")
        return F.when(F.col("overall_pass"), none).otherwise(
            F.coalesce(F.col("found").getField(field), none)
        )

    return runs.join(found, "run_id", "left").select(
        "run_id",
        (F.col("overall_pass") | (critical == 0)).alias("publish"),
        summary.alias("summary"),
        listed("root_cause").alias("root_causes"),
        listed("recommendation").alias("recommendations"),
    )
