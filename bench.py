"""Time the headline queries and one full run; prints one JSON line.

``BENCH_SF_DIR`` names the folder of the tables, ``BENCH_CPUS`` the local cores. Every
query runs once to warm up and once for the record; all its rows are computed. The full
run reads seven messy CSV tables, which are made beforehand and not timed.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from querybook import QUERIES, Tables
from querybook.clinical import AS_OF, MESSY, RUN
from rowgate.plans import healthcare as preset
from rowgate.plans.lifecycle import PublishBlocked, check_stage, clean_stage, judge_stage, publish_stage
from rowgate.session import tune
from rowgate.sources import StagingArea

HEADLINE = [
    "parse_date_multi",
    "parse_ts_multi",
    "money_parse",
    "normalize_table",
    "reject_required",
    "dedup_keep_first",
    "zscore_sequential",
    "fk_chain",
    "fk_cascade",
    "quality_report",
    "verdict",
    "histogram_50",
    "gold_fact",
]


def session() -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    tune(spark)
    return spark


def seconds(work) -> float:
    start = time.perf_counter()
    work()
    return round(time.perf_counter() - start, 3)


def time_queries(spark: SparkSession, folder: str) -> dict[str, float]:
    tables, taken = Tables(spark, folder), {}
    for name in HEADLINE:
        def run(build=QUERIES[name]):
            build(tables).write.format("noop").mode("overwrite").save()

        run()
        taken[name] = seconds(run)
    return taken


def time_full_run(spark: SparkSession, folder: str) -> dict[str, float]:
    area = StagingArea(spark)
    tables, out = Tables(spark, folder), f"{area.path}/run"
    sources = {name: f"{area.path}/raw/{name}" for name in MESSY}
    for name, path in sources.items():
        MESSY[name](tables).repartition(16).write.csv(path, header=True)
    contracts = preset.healthcare(AS_OF)

    def publish():
        try:
            publish_stage(spark, preset.FACT, preset.FACT_DIMENSIONS, f"{out}/cleaned",
                          f"{out}/verdict", f"{out}/gold", RUN)
        except PublishBlocked:
            pass

    stages = {
        "run_clean": lambda: clean_stage(
            spark, contracts, sources, f"{out}/cleaned", f"{out}/quarantine", RUN, AS_OF
        ),
        "run_check": lambda: check_stage(spark, contracts, f"{out}/cleaned", f"{out}/report", RUN),
        "run_judge": lambda: judge_stage(spark, f"{out}/report", f"{out}/verdict", RUN),
        "run_publish": publish,
    }
    for stage in stages.values():
        stage()
    return {name: seconds(stage) for name, stage in stages.items()}


def main() -> int:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session()
    taken = time_queries(spark, folder) | time_full_run(spark, folder)
    print(json.dumps({
        "metric": "total time of the headline queries and one full run",
        "value": round(sum(taken.values()), 3),
        "unit": "sec",
        "queries": taken,
        "sf": folder.rsplit("sf", 1)[-1],
    }))
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
