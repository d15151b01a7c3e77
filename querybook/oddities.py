"""Input that tidy test data does not have: infinite numbers, odd headers, glued dates, files of all sizes."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowgate import functions as fn
from rowgate.operators.checks import DateBetween, NoOutliers, Suite, run_checks
from rowgate.operators.duplicates import tag_duplicates
from rowgate.operators.histogram import Axis, histograms
from rowgate.operators.normalize import normalize
from rowgate.operators.outliers import tag_outliers
from rowgate.operators.split import clean_rows
from rowgate.sources import StagingArea, read_csv

from .book import query
from .quality import OUTCOME, RUN, histogram_sql

_ODD_SQL = """odd AS (SELECT event_id, CASE event_id % 100 WHEN 3 THEN 'Infinity'::DOUBLE
    WHEN 4 THEN '-Infinity'::DOUBLE WHEN 5 THEN 'NaN'::DOUBLE ELSE value END AS value FROM events),
  plain AS (SELECT event_id, value FROM odd WHERE isfinite(value)),
  stats AS (SELECT avg(value) AS m, stddev_samp(value) AS s FROM plain),
  judged AS (SELECT event_id, coalesce(isinf(value) OR abs((CASE WHEN isfinite(value) THEN value END - m) / s) > 3,
                                       false) AS far FROM odd, stats)"""


def _odd_events(t):
    value = F.expr(
        "case event_id % 100 when 3 then double('Infinity') when 4 then double('-Infinity') "
        "when 5 then double('NaN') else value end"
    )
    return t.events.select("event_id", value.alias("value"))


@query(f"WITH {_ODD_SQL} SELECT event_id, CASE WHEN far THEN 'zscore_outlier_value' END AS rejection_reason FROM judged")
def zscore_infinite(t):
    """An infinite reading is an outlier and does not hide the others."""
    return tag_outliers(_odd_events(t), "value").select("event_id", "rejection_reason")


@query(
    f"""WITH {_ODD_SQL} SELECT 'events' AS "table", 'value_zscore' AS "check", count(*) AS row_count,
        count(*) FILTER (WHERE far) AS fail_count, count(*) FILTER (WHERE far) = 0 AS pass FROM judged"""
)
def chk_zscore_infinite(t):
    suite = Suite("events", "event_id", [NoOutliers("value_zscore", "value")])
    return run_checks({"events": _odd_events(t)}, [suite], RUN, 0).select(*OUTCOME)


_AXIS = Axis("events", "value", 0.0, 300.0)


@query(f"WITH {_ODD_SQL} {histogram_sql(_AXIS, 'plain')}")
def histogram_infinite(t):
    counted = histograms({"events": _odd_events(t)}, [_AXIS])
    return counted.withColumns({"low": F.round("low", 6), "high": F.round("high", 6)})


@query(
    """SELECT c_custkey::VARCHAR AS "C_CustKey", lower(c_mktsegment) AS "Segment", c_acctbal AS "Acct.Bal",
              length(c_mktsegment) AS width FROM customer"""
)
def normalize_header_case(t):
    """Rules find columns in any letter case, and columns whose names hold a dot."""
    raw = t.customer.select(
        F.col("c_custkey").cast("string").alias("C_CustKey"), F.concat(F.lit(" "), "c_mktsegment").alias("Segment"),
        F.col("c_acctbal").alias("Acct.Bal"),
    )
    table = normalize(raw, columns={"segment": F.lower}, derived={"width": ("SEGMENT", lambda c: F.length(c).cast("bigint"))})
    return clean_rows(tag_duplicates(table, ["c_custkey", "Acct.Bal"]))


@query(
    """SELECT o_orderkey::VARCHAR AS o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN 'a' ELSE 'b' END AS file
       FROM orders"""
)
def dedup_file_order(t):
    """Of two files the first by name has the first copies, although the second one is larger."""
    path = StagingArea(t.spark).path
    keys = t.orders.select("o_orderkey").distinct()
    for file, rows in (("a", keys.where("o_orderkey % 10 = 0")), ("b", keys)):
        rows.withColumn("file", F.lit(file)).coalesce(1).write.csv(f"{path}/{file}", header=True)
    return clean_rows(tag_duplicates(read_csv(t.spark, [f"{path}/b", f"{path}/a"]), "o_orderkey"))


@query(
    """SELECT o_orderkey, CASE WHEN o_orderkey % 8 IN (0, 5) THEN o_orderdate::DATE END AS day,
              CASE WHEN o_orderkey % 3 = 0 THEN strftime(o_orderdate, '%Y-%m-%d 10:20:00') END AS moment
       FROM orders"""
)
def parse_date_rejects(t):
    """Two dates without anything between them, signed years and long days are no dates."""
    day = F.expr(
        """case o_orderkey % 8 when 0 then date_format(o_orderdate, 'yyyy-MM-dd')
           when 1 then date_format(o_orderdate, 'yyyy-MM-ddyyyy/MM/dd')
           when 2 then date_format(o_orderdate, 'yyyy-MM-ddM/d/yyyy')
           when 3 then concat('Jan 25, -', year(o_orderdate))
           when 4 then concat('Feb 025, ', year(o_orderdate))
           when 5 then date_format(o_orderdate, 'M/d/yyyy')
           when 6 then date_format(o_orderdate, 'M/d/yyd-M-yyyy')
           else date_format(o_orderdate, 'MMMM d, yyyyMMM d, yyyy') end"""
    )
    moment = F.expr(
        """case o_orderkey % 3 when 0 then date_format(o_orderdate, "MM/dd/yyyy '10:20'")
           when 1 then date_format(o_orderdate, "dd-MM-yyyy '10:20'M/d/yy")
           else date_format(o_orderdate, 'yyyy-MM-ddyyyy/MM/dd') end"""
    )
    return t.orders.select(
        "o_orderkey", fn.parse_date(day).alias("day"),
        F.date_format(fn.parse_timestamp(moment), "yyyy-MM-dd HH:mm:ss").alias("moment"),
    )


@query(
    """SELECT 'orders' AS "table", 'before_1900' AS "check", count(*) AS row_count,
              count(*) FILTER (WHERE o_orderkey % 6 = 1) AS fail_count,
              count(*) FILTER (WHERE o_orderkey % 6 = 1) = 0 AS pass FROM orders"""
)
def chk_date_text(t):
    """Only text that is written as a date is one: a year, a month or an hour is not."""
    text = F.expr(
        """case o_orderkey % 6 when 0 then '1850' when 1 then '1850-03-04' when 2 then '1850-03'
           when 3 then '1850-03-04T10' when 4 then '1950-03-04' end"""
    )
    suite = Suite("orders", "o_orderkey", [DateBetween("before_1900", "day", earliest="1900-01-01")])
    orders = t.orders.select("o_orderkey", text.alias("day"))
    return run_checks({"orders": orders}, [suite], RUN, 0).select(*OUTCOME)
