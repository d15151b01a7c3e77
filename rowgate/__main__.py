"""Run one stage on the clinical tables: clean, check, judge or publish.

``spark-submit rowgate/__main__.py clean --source DIR --out DIR --run-id ID``
"""

from __future__ import annotations

import argparse
import sys
from datetime import date, datetime, timezone

from pyspark.sql import SparkSession

from rowgate.plans import healthcare as preset
from rowgate.plans.lifecycle import (
    PublishBlocked,
    check_stage,
    clean_stage,
    judge_stage,
    publish_stage,
)
from rowgate.sources import read_manifest


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="rowgate", description=__doc__)
    parser.add_argument("stage", choices=["clean", "check", "judge", "publish"])
    parser.add_argument("--source", help="folder of the raw files (clean)")
    parser.add_argument("--out", required=True, help="folder of everything written")
    parser.add_argument("--run-id", required=True, help="the same for all stages of one run")
    parser.add_argument("--as-of", type=date.fromisoformat, help="today, for ages and future dates (default: "
                        "the clean stage takes the current day, the others that of the clean stage)")  # fmt: skip
    parser.add_argument("--buckets", type=int, help="deal clean tables into so many buckets by their keys (clean)")
    args = parser.parse_args(arguments)

    spark = SparkSession.builder.appName(f"rowgate-{args.stage}").getOrCreate()
    cleaned, report = f"{args.out}/cleaned", f"{args.out}/quality_report"
    stored = None if args.stage == "clean" else read_manifest(spark, cleaned).get("as_of")
    as_of = args.as_of or (date.fromisoformat(stored) if stored else date.today())
    contracts = preset.healthcare(as_of)
    verdict = f"{args.out}/verdict"
    now = datetime.now(timezone.utc).isoformat()
    if args.stage == "clean":
        sources = {name: f"{args.source}/{file}" for name, file in preset.SOURCE_FILES.items()}
        for line in clean_stage(
            spark, contracts, sources, cleaned, f"{args.out}/quarantine", args.run_id, as_of, args.buckets
        ):
            print(line)
    elif args.stage == "check":
        charts = f"{args.out}/quality_charts"
        results = check_stage(
            spark, contracts, cleaned, report, args.run_id, charts, preset.CHARTS, f"{args.out}/ledger", now
        )
        results.orderBy("ord").show(100, False)
    elif args.stage == "judge":
        judge_stage(spark, report, verdict, now).show(truncate=False)
    else:
        try:
            rows = publish_stage(
                spark, preset.FACT, preset.FACT_DIMENSIONS, cleaned, verdict,
                f"{args.out}/gold/fact_cdr.parquet", args.run_id,
            )
        except PublishBlocked as blocked:
            print(f"blocked: {blocked}")
            return 1
        print(f"published {rows} rows")
    return 0


if __name__ == "__main__":
    sys.exit(main())
