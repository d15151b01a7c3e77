"""Delimited files as they come, and what the clean stage makes of them; ledgers of runs."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowgate.operators.checks import DateBetween, NotNull, Suite, UniqueKey, NumberBetween, run_checks
from rowgate.operators.history import verdict_history as runs_of_ledger
from rowgate.operators.history import with_drift
from rowgate.operators.rules import Required
from rowgate.plans.contract import TableContract, Unique
from rowgate.plans.lifecycle import clean_stage
from rowgate.sources import (
    StagingArea, manifests, read_clean, read_csv, read_ledger, read_quarantine, read_rejected, record_run, write_split,
)

from .book import query
from .clinical import AS_OF, RUN, with_tables
from .runs import LATE, NAMES, Run


def _write_lines(lines: DataFrame, header: str, path: str) -> None:
    """One text column as it is, under a header that is text too."""
    lines.select(F.col(lines.columns[0]).alias(header)).write.csv(path, header=True, sep="\u0001", quote="")


@query(
    """SELECT o_orderkey::VARCHAR AS o_orderkey, o_custkey::VARCHAR AS o_custkey,
              CASE WHEN o_orderkey % 13 <> 5 OR o_orderkey % 11 = 3 THEN o_orderstatus END AS o_orderstatus,
              CASE WHEN o_orderkey % 11 = 3 OR o_orderkey % 13 = 5 THEN 'malformed row' END AS rejection_reason,
              CASE WHEN o_orderkey % 11 = 3 THEN concat_ws(',', o_orderkey, o_custkey, o_orderstatus, 'more')
                   WHEN o_orderkey % 13 = 5 THEN concat_ws(',', o_orderkey, o_custkey) END AS line
       FROM orders"""
)
def csv_malformed_quarantined(t):
    """Lines with a field too many or too few are quarantined as they stand; all others are clean."""
    out = StagingArea(t.spark).path
    line = F.expr(
        """case when o_orderkey % 11 = 3 then concat_ws(',', o_orderkey, o_custkey, o_orderstatus, 'more')
                when o_orderkey % 13 = 5 then concat_ws(',', o_orderkey, o_custkey)
                else concat_ws(',', o_orderkey, o_custkey, o_orderstatus) end"""
    )
    _write_lines(t.orders.select(line), "o_orderkey,o_custkey,o_orderstatus", f"{out}/raw")
    contract = TableContract("orders", "o_orderkey", rules=[Required("null key", "o_orderkey"), Unique(("o_orderkey",))])
    clean_stage(t.spark, {"orders": contract}, {"orders": f"{out}/raw"}, f"{out}/cleaned", f"{out}/quarantine", RUN)
    none = F.lit(None).cast("string")
    clean = read_clean(t.spark, f"{out}/cleaned", "orders").withColumns({"rejection_reason": none, "line": none})
    rejected = read_rejected(t.spark, f"{out}/cleaned", f"{out}/quarantine", "orders", lines=True)
    return clean.unionByName(rejected.withColumn("line", F.col("_malformed.line")).drop("_malformed"))


@query(
    """SELECT o_orderkey::VARCHAR AS o_orderkey, o_custkey::VARCHAR AS o_custkey,
              CASE WHEN o_orderkey % 3 < 2 THEN o_orderstatus END AS o_orderstatus,
              CASE WHEN o_orderkey % 3 = 2 THEN o_orderpriority END AS o_orderpriority FROM orders"""
)
def csv_header_order(t):
    """Files with their columns in other orders, in another letter case, one fewer and one more."""
    path = StagingArea(t.spark).path
    layouts = ("o_orderkey o_custkey o_orderstatus", "O_ORDERSTATUS O_ORDERKEY O_CUSTKEY", "o_orderpriority o_custkey o_orderkey")
    for i, names in enumerate(layouts):
        rows = t.orders.where(f"o_orderkey % 3 = {i}").select(*names.split())
        rows.toDF(*names.split()).write.csv(f"{path}/{i}", header=True)
    return read_csv(t.spark, [f"{path}/{i}" for i in range(len(layouts))])


@query(
    """SELECT o_orderkey, CASE o_orderkey % 4 WHEN 1 THEN 'rejected without a reason' WHEN 2 THEN 'bad'
                               WHEN 3 THEN 'rejected without a reason' END AS rejection_reason FROM orders"""
)
def empty_reason_quarantined(t):
    """Rows that are tagged with an empty reason are no clean rows."""
    out = StagingArea(t.spark).path
    reason = F.expr("case o_orderkey % 4 when 1 then '' when 2 then 'bad' when 3 then ' ' end")
    write_split(t.orders.select("o_orderkey", reason.alias("rejection_reason")), f"{out}/clean", f"{out}/rejected")
    clean = t.spark.read.parquet(f"{out}/clean")
    rejected = read_quarantine(t.spark, f"{out}/rejected", clean.schema)
    return clean.withColumn("rejection_reason", F.lit(None).cast("string")).unionByName(rejected)


@query(
    with_tables("encounters")
    + " UNION ALL ".join(
        f""" SELECT '{name}' AS "table", coalesce(rejection_reason, 'accepted') AS reason, count(*) AS row_count
             FROM {name} GROUP BY ALL""" for name in NAMES
    )
)
def accounting_by_reason(t):
    """Rows per table and reason as the jobs counted them that wrote the tables."""
    rows = [
        (line.table, reason, n)
        for line in Run(t).clean()
        for reason, n in {"accepted": line.rows_cleaned, **line.by_reason}.items() if n
    ]  # at most one row per declared reason
    return t.spark.createDataFrame(rows, "table string, reason string, row_count bigint")


def _version_sql(number: int, as_of: date) -> str:
    tables = with_tables("encounters").replace(str(AS_OF), str(as_of))
    counts = " UNION ALL ".join(
        f"""SELECT {number}::BIGINT AS version, '{name}' AS "table", count(*) FILTER (WHERE rejection_reason IS NULL)
            AS clean, count(*) FILTER (WHERE rejection_reason IS NOT NULL) AS rejected FROM {name}""" for name in NAMES
    )
    return f"({tables} {counts})"


@query(" UNION ALL ".join(_version_sql(i, d) for i, d in enumerate((date(1960, 1, 1), AS_OF, LATE), 1)))
def versions_readable(t):
    """Three runs over the same files on other days: the rows of every version, read after the last one."""
    run = Run(t, date(1960, 1, 1))
    run.clean()
    for run_again in (AS_OF, LATE):
        run.on(run_again).clean()
    parts = []
    for number, manifest in enumerate(manifests(t.spark, f"{run.out}/cleaned"), 1):
        for name in NAMES:
            clean = read_clean(t.spark, f"{run.out}/cleaned", name, manifest["version"])
            rejected = read_rejected(t.spark, f"{run.out}/cleaned", f"{run.out}/quarantine", name, manifest["version"])
            both = clean.select(F.lit(True).alias("ok")).unionAll(rejected.select(F.lit(False)))
            parts.append(both.agg(
                F.lit(number).cast("bigint").alias("version"), F.lit(name).alias("table"),
                F.count_if("ok").alias("clean"), F.count_if(~F.col("ok")).alias("rejected"),
            ))
    return reduce(DataFrame.unionByName, parts)


#: Three runs over more of the orders each time: rows up to a share of the keys, prices that may be at most so high.
_RUNS = (("r1", "2026-01-01", 4, 300000.0), ("r2", "2026-01-02", 5, 200000.0), ("r3", "2026-01-03", 6, 600000.0))


def _ledger(t) -> DataFrame:
    path = StagingArea(t.spark).path
    for run_id, at, upto, limit in (_RUNS[0], _RUNS[0], *_RUNS[1:]):  # the first one is recorded twice
        rows = t.orders.where(f"o_orderkey % 6 < {upto}").withColumn("clerk", F.expr("if(o_orderkey % 50 = 1, null, o_orderpriority)"))
        suite = Suite("orders", "o_orderkey", [
            NotNull("null_clerk", "clerk"), UniqueKey("duplicate_pk", "o_orderkey"),
            NumberBetween("price_range", "o_totalprice", 0.0, limit), DateBetween("ordered_before_1995", "o_orderdate", earliest="1995-01-01"),
        ])
        record_run(run_checks({"orders": rows}, [suite], run_id), path, at)
    return read_ledger(t.spark, path)


_DRIFT_SQL = (
    "WITH o AS (SELECT o_orderkey % 6 AS part, o_orderkey % 50 = 1 AS nameless, o_totalprice AS price, o_orderdate AS day,"
    " row_number() OVER (PARTITION BY o_orderkey) > 1 AS again FROM orders), r AS ("
    + " UNION ALL ".join(
        f"""SELECT '{run_id}' AS run_id, '{at}' AS recorded_at, count(*) AS n,
            unnest([{{'c': 'null_clerk', 'f': count(*) FILTER (WHERE nameless)}},
                    {{'c': 'duplicate_pk', 'f': count(*) FILTER (WHERE again)}},
                    {{'c': 'price_range', 'f': count(*) FILTER (WHERE price > {limit} OR price < 0)}},
                    {{'c': 'ordered_before_1995', 'f': count(*) FILTER (WHERE day < DATE '1995-01-01')}}], recursive := true)
            FROM o WHERE part < {upto}""" for run_id, at, upto, limit in _RUNS
    )
    + """), d AS (SELECT *, lag(run_id) OVER w AS previous_run, lag(f) OVER w AS previous_count, f / n AS share,
                         f / n - lag(f / n) OVER w AS drift FROM r WINDOW w AS (PARTITION BY c ORDER BY recorded_at)),
    e AS (SELECT *, CASE WHEN previous_run IS NULL THEN 'new' WHEN previous_count = 0 AND f > 0 THEN 'broken'
                         WHEN previous_count > 0 AND f = 0 THEN 'fixed' WHEN drift > 0 THEN 'worse'
                         WHEN drift < 0 THEN 'better' ELSE 'same' END AS change FROM d)"""
)


@query(
    f"""{_DRIFT_SQL} SELECT run_id, c AS "check", f AS fail_count, n AS row_count, previous_run, previous_count,
        round(drift, 9) AS drift, change FROM e"""
)
def check_drift(t):
    """Every check of three runs with the run before."""
    return with_drift(_ledger(t)).select(
        "run_id", "check", "fail_count", "row_count", "previous_run", "previous_count",
        F.round("drift", 9).alias("drift"), "change",
    )


@query(
    f"""{_DRIFT_SQL} SELECT run_id, recorded_at, count(*) AS checks, count(*) FILTER (WHERE f > 0) AS failed,
        count(*) FILTER (WHERE f > 0 AND (c IN ('null_clerk', 'duplicate_pk') OR share > 0.05)) AS critical,
        count(*) FILTER (WHERE f > 0 AND (c IN ('null_clerk', 'duplicate_pk') OR share > 0.05)) = 0 AS publish,
        count(*) FILTER (WHERE change = 'broken') AS broken, count(*) FILTER (WHERE change = 'fixed') AS fixed,
        count(*) FILTER (WHERE change = 'worse') AS worse, count(*) FILTER (WHERE change = 'better') AS better,
        round(max(drift), 9) AS largest_drift FROM e GROUP BY run_id, recorded_at"""
)
def verdict_history(t):
    """The verdicts of three runs, with what changed since the run before."""
    runs = runs_of_ledger(_ledger(t)).drop("summary", "data_version")
    return runs.withColumn("largest_drift", F.round("largest_drift", 9))
