"""The four stages over files: messy CSV in, clean and quarantined rows, report, verdict, gold."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowgate.operators.histogram import Axis
from rowgate.plans.healthcare import FACT, FACT_DIMENSIONS, healthcare
from rowgate.plans.lifecycle import PublishBlocked, check_stage, clean_stage, judge_stage, publish_stage
from rowgate.sources import StagingArea, read_clean, read_parquet, read_rejected

from .book import query
from .clinical import AS_OF, COLUMNS, FIRST_BY, MESSY, RUN, with_tables
from .quality import histogram_sql

#: A day on which no encounter is in the future, so that a run may be published.
LATE = date(2100, 1, 1)
NAMES = ("patients", "encounters", "providers")
CHART = Axis("encounters", "total_charge_usd", 0.0, 500000.0)


class Run:
    """One run over CSV files that Spark derives from the test tables."""

    def __init__(self, t, as_of: date = AS_OF, buckets: int | None = None):
        self.spark, self.as_of, self.buckets = t.spark, as_of, buckets
        self.out = StagingArea(t.spark).path
        every = healthcare(as_of, FIRST_BY)
        self.contracts = {name: every[name] for name in NAMES}
        self.sources = {name: f"{self.out}/raw/{name}" for name in NAMES}
        for name, path in self.sources.items():
            MESSY[name](t).write.csv(path, header=True)

    def on(self, as_of: date) -> Run:
        """The same files and folders, cleaned on another day."""
        self.as_of = as_of
        every = healthcare(as_of, FIRST_BY)
        self.contracts = {name: every[name] for name in NAMES}
        return self

    def clean(self):
        return clean_stage(
            self.spark, self.contracts, self.sources, f"{self.out}/cleaned", f"{self.out}/quarantine", RUN, self.as_of,
            self.buckets,
        )

    def check(self) -> DataFrame:
        return check_stage(
            self.spark, self.contracts, f"{self.out}/cleaned", f"{self.out}/report", RUN, f"{self.out}/charts", [CHART]
        )

    def judge(self) -> DataFrame:
        return judge_stage(self.spark, f"{self.out}/report", f"{self.out}/verdict", RUN)

    def publish(self) -> int:
        return publish_stage(
            self.spark, FACT, FACT_DIMENSIONS, f"{self.out}/cleaned", f"{self.out}/verdict", f"{self.out}/gold", RUN
        )


_LATE_SQL = with_tables("encounters").replace(str(AS_OF), str(LATE))
_GOLD_SQL = f"""{_LATE_SQL}
    SELECT {", ".join(f"e.{c}" for c in COLUMNS["encounters"].split())}, date_of_birth, gender, insurance,
           specialty AS provider_specialty, board_certified AS provider_board_certified
    FROM encounters e
    LEFT JOIN (SELECT patient_id, date_of_birth, gender, insurance FROM patients
               WHERE rejection_reason IS NULL) p ON p.patient_id = e.patient_id
    LEFT JOIN (SELECT provider_id, specialty, board_certified FROM providers
               WHERE rejection_reason IS NULL) q ON q.provider_id = e.provider_id
    WHERE e.rejection_reason IS NULL"""


@query(_GOLD_SQL)
def run_end_to_end(t):
    """Clean, check, judge and publish; the gold table is read back."""
    run = Run(t, LATE)
    run.clean()
    run.check()
    run.judge()
    run.publish()
    return read_parquet(t.spark, f"{run.out}/gold")


@query(_GOLD_SQL)
def run_bucketed(t):
    """The same run over clean tables that are bucketed by their keys."""
    run = Run(t, LATE, buckets=8)
    run.clean()
    run.check()
    run.judge()
    run.publish()
    return read_parquet(t.spark, f"{run.out}/gold")


@query(
    f"""{_LATE_SQL}
        SELECT 'judged' AS step, count(*) AS published FROM encounters WHERE rejection_reason IS NULL
        UNION ALL SELECT 'cleaned again', NULL
        UNION ALL SELECT 'judged again', count(*) FROM encounters WHERE rejection_reason IS NULL"""
)
def publish_stale_clean(t):
    """Rows published after judging, after cleaning again, and after judging again; NULL is blocked."""
    run = Run(t, LATE)

    def publish() -> int | None:
        try:
            return run.publish()
        except PublishBlocked:
            return None

    def judge() -> None:
        run.check()
        run.judge()

    run.clean()
    judge()
    steps = [("judged", publish())]
    run.clean()
    steps.append(("cleaned again", publish()))
    judge()
    steps.append(("judged again", publish()))
    return t.spark.createDataFrame(steps, "step string, published bigint")


@query(
    with_tables("encounters")
    + " UNION ALL ".join(
        f""" SELECT '{name}' AS "table", rejection_reason, count(*) AS row_count
             FROM {name} GROUP BY ALL""" for name in NAMES
    )
)
def clean_quarantine_written(t):
    """Rows per table and reason as the clean stage wrote them; accepted ones have none."""
    run = Run(t)
    run.clean()
    parts = []
    for name in NAMES:
        clean = read_clean(t.spark, f"{run.out}/cleaned", name)
        rejected = read_rejected(t.spark, f"{run.out}/cleaned", f"{run.out}/quarantine", name)
        parts += [clean.withColumn("rejection_reason", F.lit(None).cast("string")), rejected]
        parts[-2:] = [
            part.groupBy("rejection_reason").agg(F.count(F.lit(1)).alias("row_count")).withColumn("table", F.lit(name))
            for part in parts[-2:]
        ]
    return reduce(DataFrame.unionByName, parts)


@query(
    f"""{with_tables("encounters")},
        encounters_c AS (SELECT * FROM encounters WHERE rejection_reason IS NULL),
        n AS (SELECT 'patients' AS t, count(*) AS n FROM patients WHERE rejection_reason IS NULL
              UNION ALL SELECT 'providers', count(*) FROM providers WHERE rejection_reason IS NULL
              UNION ALL SELECT 'encounters', count(*) FROM encounters_c)
        SELECT 'row_counts' AS chart, t AS label, NULL::INTEGER AS bin, n::BIGINT AS value FROM n
        UNION ALL SELECT 'failures_by_table', t, NULL, CASE WHEN t = 'encounters' AND
            (SELECT count(*) FROM encounters_c WHERE encounter_date > '{AS_OF}') > 0 THEN 1 ELSE 0 END FROM n
        UNION ALL SELECT 'fk_violations', 'encounters.fk_patient_id', NULL, 0
        UNION ALL SELECT 'fk_violations', 'encounters.fk_provider_id', NULL, 0
        UNION ALL SELECT 'histograms', "table" || '.' || "column", bin, row_count
                  FROM ({histogram_sql(CHART, "encounters_c")})"""
)
def charts_written(t):
    """The numbers behind the charts, as the check stage wrote them."""
    run = Run(t)
    run.clean()
    run.check()

    def chart(name: str, label, value: str, bin_number=F.lit(None).cast("int")):
        rows = read_parquet(t.spark, f"{run.out}/charts/{name}")
        return rows.select(F.lit(name).alias("chart"), label.alias("label"), bin_number.alias("bin"), F.col(value).cast("bigint").alias("value"))

    charts = [
        chart("row_counts", F.col("table"), "row_count"),
        chart("failures_by_table", F.col("table"), "failed_checks"),
        chart("fk_violations", F.col("label"), "fail_count"),
        chart("histograms", F.concat_ws(".", "table", "column"), "row_count", F.col("bin")),
    ]
    return reduce(DataFrame.unionByName, charts)
