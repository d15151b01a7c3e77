"""Checks, reports, verdicts and the publish gate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowgate import fixed_values as fixed
from rowgate.operators import checks as ck
from rowgate.operators.enrich import enrich
from rowgate.operators.histogram import Axis, histograms
from rowgate.operators.verdict import failures, verdicts
from rowgate.plans.lifecycle import PublishBlocked, publish_if
from rowgate.sources import StagingArea, read_parquet, read_report, write_report

from .book import query
from .relations import GOLD_DIMENSIONS, GOLD_SQL, star

RUN = "2026-06-27T10:00:00"
OUTCOME = ("table", "check", "row_count", "fail_count", "pass")


def messy_tables(t) -> dict[str, DataFrame]:
    """Orders, lines and events with missing keys, dead references and bad codes."""
    orders = t.orders.select(
        F.expr("if(o_orderkey % 50 = 0, null, o_orderkey)").alias("order_id"),
        F.expr("if(o_orderkey % 13 = 0, o_custkey + 1000000000, o_custkey)").alias("customer_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date"),
        "o_totalprice",
    )
    lines = t.lineitem.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("line_id"),
        F.col("l_orderkey").alias("order_id"),
        F.expr("if(l_partkey % 11 = 0, 'bad', concat('A', lpad(l_partkey % 100, 2, '0')))").alias(
            "code"
        ),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("ship_date"),
        "l_quantity",
    )
    events = t.events.select("event_id", "user_id", "value")
    customers = t.customer.select(F.col("c_custkey").alias("customer_id"))
    return {"orders": orders, "lines": lines, "events": events, "customers": customers}


ORDERS_SUITE = ck.Suite(
    "orders",
    "order_id",
    [
        ck.NotNull("null_order_id", "order_id"),
        ck.DateBetween("future_order_date", "order_date", latest="2000-12-31"),
        ck.DateBetween("order_date_before_1900", "order_date", earliest=fixed.OLDEST_DATE),
        ck.HasParent("fk_customer_id", "customer_id", "customers"),
        ck.UniqueKey("duplicate_pk", "order_id"),
    ],
)
LINES_SUITE = ck.Suite(
    "lines",
    "line_id",
    [
        ck.NotNull("null_line_id", "line_id"),
        ck.HasParent("fk_order_id", "order_id", "orders"),
        ck.Pattern("icd10_format", "code", fixed.ICD10),
        ck.NumberBetween("quantity_range", "l_quantity", 2.0, 50.0),
        ck.DateBetween("ship_date_window", "ship_date", "1995-02-01", "2001-10-01"),
        ck.UniqueKey("duplicate_pk", "line_id"),
    ],
)
EVENTS_SUITE = ck.Suite(
    "events",
    "event_id",
    [
        ck.NotNull("null_event_id", "event_id"),
        ck.NumberBetween("value_range", "value", 0.0, 300.0),
        ck.NoOutliers("value_zscore", "value"),
        ck.HasParent("fk_user_id", "user_id", "customers", "customer_id"),
        ck.UniqueKey("duplicate_pk", "event_id"),
    ],
)
SUITES = [ORDERS_SUITE, LINES_SUITE, EVENTS_SUITE]

_MESSY_SQL = """
  ord AS (SELECT CASE WHEN o_orderkey % 50 <> 0 THEN o_orderkey END AS order_id,
                 CASE WHEN o_orderkey % 13 = 0 THEN o_custkey + 1000000000 ELSE o_custkey END
                   AS customer_id, o_orderdate::DATE AS order_date FROM orders),
  lin AS (SELECT l_orderkey * 10 + l_linenumber AS line_id, l_orderkey AS order_id,
                 l_partkey % 11 = 0 AS bad_code, l_shipdate::DATE AS ship_date, l_quantity
          FROM lineitem),
  z AS (SELECT event_id, abs((value - m) / s) > 3 AS far
        FROM events, (SELECT avg(value) AS m, stddev_samp(value) AS s FROM events)),
  bad AS (
    SELECT 'orders' AS t, 'null_order_id' AS c, NULL::BIGINT AS id FROM ord WHERE order_id IS NULL
    UNION ALL SELECT 'orders', 'future_order_date', order_id FROM ord
      WHERE order_date > DATE '2000-12-31'
    UNION ALL SELECT 'orders', 'fk_customer_id', order_id FROM ord
      WHERE customer_id NOT IN (SELECT c_custkey FROM customer)
    UNION ALL SELECT 'orders', 'duplicate_pk', order_id FROM
      (SELECT order_id, row_number() OVER (PARTITION BY order_id) AS rn FROM ord) WHERE rn > 1
    UNION ALL SELECT 'lines', 'fk_order_id', line_id FROM lin
      WHERE NOT EXISTS (SELECT 1 FROM ord WHERE ord.order_id = lin.order_id)
    UNION ALL SELECT 'lines', 'icd10_format', line_id FROM lin WHERE bad_code
    UNION ALL SELECT 'lines', 'quantity_range', line_id FROM lin WHERE l_quantity NOT BETWEEN 2 AND 50
    UNION ALL SELECT 'lines', 'ship_date_window', line_id FROM lin
      WHERE ship_date NOT BETWEEN DATE '1995-02-01' AND DATE '2001-10-01'
    UNION ALL SELECT 'lines', 'duplicate_pk', line_id FROM
      (SELECT line_id, row_number() OVER (PARTITION BY line_id) AS rn FROM lin) WHERE rn > 1
    UNION ALL SELECT 'events', 'value_range', event_id FROM events WHERE value > 300 OR value < 0
    UNION ALL SELECT 'events', 'value_zscore', event_id FROM z WHERE far
    UNION ALL SELECT 'events', 'fk_user_id', event_id FROM events
      WHERE user_id NOT IN (SELECT c_custkey FROM customer)
  ),
  declared(t, c, ord, sampled) AS (VALUES
    ('orders', 'null_order_id', 0, false), ('orders', 'future_order_date', 1, true),
    ('orders', 'order_date_before_1900', 2, true), ('orders', 'fk_customer_id', 3, true),
    ('orders', 'duplicate_pk', 4, true), ('lines', 'null_line_id', 5, false),
    ('lines', 'fk_order_id', 6, true), ('lines', 'icd10_format', 7, true),
    ('lines', 'quantity_range', 8, true), ('lines', 'ship_date_window', 9, true),
    ('lines', 'duplicate_pk', 10, true), ('events', 'null_event_id', 11, false),
    ('events', 'value_range', 12, true), ('events', 'value_zscore', 13, false),
    ('events', 'fk_user_id', 14, true), ('events', 'duplicate_pk', 15, true)),
  totals AS (SELECT 'orders' AS t, count(*) AS n FROM orders
             UNION ALL SELECT 'lines', count(*) FROM lineitem
             UNION ALL SELECT 'events', count(*) FROM events),
  ids AS (SELECT t, c, id, row_number() OVER (PARTITION BY t, c ORDER BY id) AS rn FROM
            (SELECT t, c, id FROM bad WHERE id IS NOT NULL AND c <> 'duplicate_pk'
             UNION ALL SELECT DISTINCT t, c, id FROM bad
               WHERE id IS NOT NULL AND c = 'duplicate_pk'
             UNION ALL SELECT DISTINCT t, c, id FROM bad WHERE id IS NULL AND c = 'duplicate_pk')),
  sampled AS (SELECT t, c, string_agg(coalesce(substr(id::VARCHAR, 1, 4), 'None') || '***', ','
                ORDER BY rn) AS ids FROM ids WHERE rn <= 5 GROUP BY ALL),
  res AS (SELECT d.t, d.c, d.ord, totals.n AS rows, count(bad.t) AS fails,
                 CASE WHEN any_value(d.sampled) THEN coalesce(any_value(sampled.ids), '')
                      ELSE '' END AS ids
          FROM declared d JOIN totals ON totals.t = d.t
          LEFT JOIN bad ON bad.t = d.t AND bad.c = d.c
          LEFT JOIN sampled ON sampled.t = d.t AND sampled.c = d.c
          GROUP BY d.t, d.c, d.ord, totals.n)"""
_RES = f"WITH {_MESSY_SQL} "
_OUTCOME_SQL = """t AS "table", c AS "check", rows AS row_count, fails AS fail_count,
                  fails = 0 AS pass"""


def check_results(t, sample_size: int = 0) -> DataFrame:
    """All three suites, run once and written: what follows reads the few result rows."""
    area = StagingArea(t.spark)
    return area.stage(run_checks(t, SUITES, sample_size, area), "check-results")


def run_checks(t, suites, sample_size: int = 0, area=None) -> DataFrame:
    return ck.run_checks(messy_tables(t), suites, RUN, sample_size, area)


def _single_check(suite: ck.Suite, name: str, function: str):
    only = ck.Suite(suite.table, suite.key, [c for c in suite.checks if c.name == name])

    def build(t):
        return run_checks(t, [only]).select(*OUTCOME)

    build.__name__ = function
    build.__doc__ = f"The {name} check of {suite.table} alone."
    query(
        f"{_RES} SELECT {_OUTCOME_SQL} FROM res WHERE t = '{suite.table}' AND c = '{name}'"
    )(build)


_single_check(ORDERS_SUITE, "null_order_id", "chk_null")
_single_check(LINES_SUITE, "duplicate_pk", "chk_dup")
_single_check(LINES_SUITE, "ship_date_window", "chk_date")
_single_check(EVENTS_SUITE, "value_range", "chk_range")
_single_check(EVENTS_SUITE, "value_zscore", "chk_zscore")
_single_check(ORDERS_SUITE, "fk_customer_id", "chk_fk")
_single_check(LINES_SUITE, "icd10_format", "chk_pattern")


def _sample_text():
    return F.coalesce(F.concat_ws(",", "sample_ids"), F.lit("")).alias("sample_ids")


@query(
    _RES + """SELECT t AS "table", c AS "check", ids AS sample_ids FROM res WHERE fails > 0"""
)
def sample_failing(t):
    failed = check_results(t, fixed.SAMPLE_SIZE).where(~F.col("pass"))
    return failed.select("table", "check", _sample_text())


_REPORT_SQL = _RES + f"SELECT {_OUTCOME_SQL}, ord, ids AS sample_ids FROM res"


@query(_REPORT_SQL)
def quality_report(t):
    return check_results(t, fixed.SAMPLE_SIZE).select(*OUTCOME, "ord", _sample_text())


@query(_REPORT_SQL)
def report_json_roundtrip(t):
    path = f"{StagingArea(t.spark).path}/report"
    write_report(check_results(t, fixed.SAMPLE_SIZE), path)
    stored = read_report(t.spark, path)[0]
    return stored.select(*OUTCOME, "ord", _sample_text())


@query(_RES + f"SELECT '{RUN}' AS run_id, bool_and(fails = 0) AS overall_pass FROM res")
def overall_pass(t):
    return ck.overall_pass(check_results(t))


@query(_RES + f"""SELECT '{RUN}' AS run_id, t AS "table", max(rows) AS row_count FROM res GROUP BY t""")
def row_counts(t):
    return ck.row_counts(check_results(t))


@query(
    _RES + f"""SELECT '{RUN}' AS run_id, t AS "table",
               count(*) FILTER (WHERE fails > 0) AS failed_checks FROM res GROUP BY t"""
)
def failures_by_table(t):
    return ck.failures_by_table(check_results(t))


@query(
    _RES + f"""SELECT '{RUN}' AS run_id, t || '.' || c AS label, fails AS fail_count FROM res
               WHERE c LIKE 'fk\\_%' ESCAPE '\\'"""
)
def fk_violations(t):
    return ck.fk_violations(check_results(t))


VERDICT_SQL = """
  shares AS (SELECT *, fails / rows::DOUBLE AS share,
                    printf('%.1f%%', fails / rows::DOUBLE * 100) AS pct FROM res WHERE fails > 0),
  judged AS (SELECT *, c IN ('duplicate_pk', 'icd10_format') OR c LIKE 'null\\_%' ESCAPE '\\'
               OR c LIKE 'fk\\_%' ESCAPE '\\' OR share > 0.05 AS critical FROM shares),
  found AS (SELECT t, c, ord, critical, CASE WHEN critical THEN
      t || '.' || c || ': ' || fails || ' rows (' || pct || ') — CRITICAL: ' ||
      CASE WHEN c LIKE 'null\\_%' ESCAPE '\\' THEN 'null primary key.'
           WHEN c = 'duplicate_pk' THEN 'duplicate primary keys.'
           WHEN c LIKE 'fk\\_%' ESCAPE '\\'
             THEN 'foreign key violation — referential integrity broken.'
           WHEN c = 'icd10_format' THEN 'malformed ICD-10 code.'
           ELSE 'exceeds 5% failure threshold (' || pct || ' of table).' END
      ELSE t || '.' || c || ': ' || fails ||
           ' rows — MINOR: low count, no referential integrity impact.' END AS cause,
      CASE WHEN critical THEN 'Investigate and resolve ' || t || '.' || c ||
                              ' before re-running the pipeline.'
           ELSE 'Review ' || t || '.' || c || ' — acceptable to publish with monitoring.' END
        AS advice FROM judged)"""
VERDICT_SELECT = """
  SELECT '{run}' AS run_id, coalesce(bool_and(NOT critical), true) AS publish,
    CASE WHEN count(*) = 0
           THEN 'All quality checks passed with no failures detected across all tables.'
         WHEN bool_or(critical) THEN count(*) FILTER (WHERE critical) ||
           ' critical failure(s) detected — Gold layer write is blocked until issues are resolved.'
         ELSE count(*) || ' minor quality issue(s) detected but no critical failures — ' ||
              'data is safe to publish with warnings.' END AS summary,
    coalesce(string_agg(cause, chr(10) ORDER BY critical DESC, ord), '') AS root_causes,
    coalesce(string_agg(advice, chr(10) ORDER BY critical DESC, ord), '') AS recommendations
  FROM found{where}"""


def verdict_text(verdict: DataFrame) -> DataFrame:
    return verdict.select(
        "run_id",
        "publish",
        "summary",
        F.concat_ws("\n", "root_causes").alias("root_causes"),
        F.concat_ws("\n", "recommendations").alias("recommendations"),
    )


@query(
    f"""WITH {_MESSY_SQL}, {VERDICT_SQL}
        SELECT t AS "table", c AS "check", CASE WHEN critical THEN 'CRITICAL' ELSE 'MINOR' END
          AS severity, cause AS root_cause FROM found"""
)
def severity(t):
    return failures(check_results(t)).select("table", "check", "severity", "root_cause")


@query(
    f"""WITH {_MESSY_SQL}, {VERDICT_SQL}
        SELECT t AS "table", c AS "check", advice AS recommendation FROM found"""
)
def recommendations(t):
    return failures(check_results(t)).select("table", "check", "recommendation")


@query(f"WITH {_MESSY_SQL}, {VERDICT_SQL} {VERDICT_SELECT.format(run=RUN, where='')}")
def verdict(t):
    return verdict_text(verdicts(check_results(t)))


def _minor_only(t) -> DataFrame:
    """The outcome of a run in which only the outlier check of the events failed."""
    suite = ck.Suite(
        "events", "event_id", [c for c in EVENTS_SUITE.checks if c.name != "fk_user_id"]
    )
    return run_checks(t, [suite])


@query(
    f"""WITH {_MESSY_SQL}, {VERDICT_SQL} {VERDICT_SELECT.format(
        run=RUN, where=" WHERE t = 'events' AND c <> 'fk_user_id'")}"""
)
def verdict_with_warnings(t):
    return verdict_text(verdicts(_minor_only(t)))


def _publish(t, verdict: DataFrame, path: str) -> None:
    tables = star(t)
    gold = enrich(tables["lines"], tables, GOLD_DIMENSIONS)
    publish_if(verdict, RUN, tables["lines"], gold, path)


@query(GOLD_SQL)
def publish_allowed(t):
    """A run with warnings only: the fact is written, and read back."""
    path = f"{StagingArea(t.spark).path}/gold"
    _publish(t, verdicts(_minor_only(t)), path)
    return read_parquet(t.spark, path)


@query(
    f"""WITH {_MESSY_SQL}, {VERDICT_SQL},
        v AS ({VERDICT_SELECT.format(run=RUN, where='')})
        SELECT run_id, NOT publish AS blocked, summary FROM v"""
)
def publish_blocked(t):
    """A run with critical failures: the gate raises, with the summary of the verdict."""
    judged = verdicts(check_results(t))
    raised = ""
    try:
        _publish(t, judged, f"{StagingArea(t.spark).path}/gold")
    except PublishBlocked as blocked:
        raised = str(blocked)
    return judged.select("run_id", (F.col("summary") == raised).alias("blocked"), "summary")


_AXES = [
    Axis("events", "value", 0.0, 300.0),
    Axis("lineitem", "l_extendedprice", 0.0, 100000.0),
    Axis("lineitem", "l_quantity", 0.0, 50.0),
]


def histogram_sql(axis: Axis, table: str) -> str:
    """The same histogram from a SQL table; bins meet the same edges."""
    column, low, high = axis.column, axis.limit_low, axis.limit_high
    return f"""
      SELECT '{axis.table}' AS "table", '{column}' AS "column", b.bin::INTEGER AS bin,
             round(lo + b.bin * w, 6) AS low,
             round(CASE WHEN b.bin = 49 THEN hi ELSE lo + (b.bin + 1) * w END, 6) AS high,
             count(x.bin) AS row_count, {low}::DOUBLE AS limit_low, {high}::DOUBLE AS limit_high
      FROM (SELECT min({column}) AS lo, max({column}) AS hi,
                   (max({column}) - min({column})) / 50 AS w FROM {table}) r
      CROSS JOIN range(50) b(bin)
      LEFT JOIN (SELECT CASE WHEN v >= lo + (g + 1) * w AND g < 49 THEN g + 1
                             WHEN v < lo + g * w THEN g - 1 ELSE g END AS bin
                 FROM (SELECT {column} AS v, lo, (hi - lo) / 50 AS w,
                              least(floor(({column} - lo) / (hi - lo) * 50), 49) AS g
                       FROM {table}, (SELECT min({column}) AS lo, max({column}) AS hi FROM {table})
                       WHERE {column} IS NOT NULL)
                ) x ON x.bin = b.bin
      GROUP BY b.bin, lo, hi, w"""


@query(" UNION ALL ".join(histogram_sql(axis, axis.table) for axis in _AXES))
def histogram_50(t):
    counted = histograms({"events": t.events, "lineitem": t.lineitem}, _AXES)
    return counted.withColumns({"low": F.round("low", 6), "high": F.round("high", 6)})
