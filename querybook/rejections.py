"""Rules that reject rows, and the split into clean and quarantine."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from rowgate import fixed_values as fixed
from rowgate.functions import parse_date
from rowgate.operators.duplicates import tag_duplicates
from rowgate.operators.outliers import tag_outliers
from rowgate.operators.rules import Matches, NotAfter, Required, Within, tag_rows
from rowgate.operators.split import accounting, clean_rows, quarantined_rows, rejections_by_reason
from rowgate.plans.contract import NotOutlying, TableContract, Unique, tag_table

from .book import query

LINE_KEY = ("l_orderkey", "l_linenumber")
LINE_ORDER = (
    "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate",
)
LINE_COLUMNS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")


@query(
    """SELECT o_orderkey, CASE WHEN o_orderkey % 50 = 0 THEN 'null order_id'
         WHEN o_orderkey % 20 = 0 THEN 'null customer_id'
         WHEN o_orderkey % 11 = 0 THEN 'unparseable date in order_date' END AS rejection_reason
       FROM orders"""
)
def reject_required(t):
    orders = t.orders.select(
        "o_orderkey",
        F.expr("case when o_orderkey % 50 <> 0 then o_orderkey end").alias("order_id"),
        F.expr("case when o_orderkey % 20 <> 0 then o_custkey end").alias("customer_id"),
        parse_date(
            F.expr(
                "case when o_orderkey % 11 = 0 then 'soon' "
                "else date_format(o_orderdate, 'MM/dd/yyyy') end"
            )
        ).alias("order_date"),
    )
    rules = [
        Required("null order_id", "order_id"),
        Required("null customer_id", "customer_id"),
        Required("unparseable date in order_date", "order_date"),
    ]
    return tag_rows(orders, rules).select("o_orderkey", "rejection_reason")


@query(
    """SELECT o_orderkey, CASE WHEN o_orderdate::DATE > DATE '2000-06-30'
         THEN 'future order_date' END AS rejection_reason FROM orders"""
)
def reject_future(t):
    orders = t.orders.select("o_orderkey", F.col("o_orderdate").cast("date").alias("order_date"))
    rules = [NotAfter("future order_date", "order_date", date(2000, 6, 30))]
    return tag_rows(orders, rules).select("o_orderkey", "rejection_reason")


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
         CASE WHEN l_partkey % 11 = 0 THEN 'malformed code' END AS rejection_reason FROM lineitem"""
)
def reject_pattern(t):
    lines = t.lineitem.select(
        *LINE_COLUMNS,
        F.expr(
            "case when l_partkey % 11 = 0 then 'bad' "
            "else concat('A', lpad(l_partkey % 100, 2, '0'), '.1') end"
        ).alias("code"),
    )
    return tag_rows(lines, [Matches("malformed code", "code", fixed.ICD10)]).drop("code")


@query(
    """SELECT event_id, CASE WHEN event_id % 9 <> 0 AND (value < 2.5 OR value > 150)
         OR user_id < 10 THEN 'out of range' END AS rejection_reason FROM events"""
)
def reject_range(t):
    events = t.events.select(
        "event_id", "user_id", F.expr("case when event_id % 9 <> 0 then value end").alias("value")
    )
    rules = [Within("out of range", {"value": (2.5, 150.0), "user_id": (10, 10**12)})]
    return tag_rows(events, rules).select("event_id", "rejection_reason")


_RANKED = f"""(SELECT *, row_number() OVER (PARTITION BY {', '.join(LINE_KEY)}
                 ORDER BY {', '.join(LINE_ORDER)}) AS rn FROM lineitem)"""


@query(f"SELECT {', '.join(LINE_COLUMNS)} FROM {_RANKED} WHERE rn = 1")
def dedup_keep_first(t):
    return clean_rows(tag_duplicates(t.lineitem, LINE_KEY, LINE_ORDER)).select(*LINE_COLUMNS)


@query(
    f"""SELECT {', '.join(LINE_COLUMNS)}, 'duplicate primary key' AS rejection_reason
        FROM {_RANKED} WHERE rn > 1"""
)
def dedup_extras(t):
    extras = quarantined_rows(tag_duplicates(t.lineitem, LINE_KEY, LINE_ORDER))
    return extras.select(*LINE_COLUMNS, "rejection_reason")


@query(
    """SELECT event_id, CASE WHEN abs((value - m) / nullif(s, 0)) > 3
         THEN 'zscore_outlier_value' END AS rejection_reason
       FROM events, (SELECT avg(value) AS m, stddev_samp(value) AS s FROM events)"""
)
def zscore_reject(t):
    return tag_outliers(t.events, "value").select("event_id", "rejection_reason")


def _two_measures(t):
    return t.events.select("event_id", "value", (F.col("value") * F.col("value")).alias("square"))


@query(
    """WITH e AS (SELECT event_id, value, value * value AS square FROM events),
       s1 AS (SELECT avg(value) AS m, stddev_samp(value) AS s FROM e),
       a AS (SELECT e.*, coalesce(abs((value - m) / nullif(s, 0)) > 3, false) AS out1 FROM e, s1),
       s2 AS (SELECT avg(square) AS m, stddev_samp(square) AS s FROM a WHERE NOT out1)
       SELECT event_id, CASE WHEN out1 THEN 'zscore_outlier_value'
              WHEN abs((square - m) / nullif(s, 0)) > 3 THEN 'zscore_outlier_square' END
              AS rejection_reason FROM a, s2"""
)
def zscore_sequential(t):
    tagged = tag_outliers(_two_measures(t), ["value", "square"])
    return tagged.select("event_id", "rejection_reason")


@query(
    """WITH e AS (SELECT event_id, value, value * value AS square FROM events),
       s AS (SELECT avg(value) AS m1, stddev_samp(value) AS s1, avg(square) AS m2,
                    stddev_samp(square) AS s2 FROM e)
       SELECT event_id, CASE WHEN abs((value - m1) / nullif(s1, 0)) > 3 THEN 'zscore_outlier_value'
              WHEN abs((square - m2) / nullif(s2, 0)) > 3 THEN 'zscore_outlier_square' END
              AS rejection_reason FROM e, s"""
)
def zscore_joint(t):
    tagged = tag_outliers(_two_measures(t), ["value", "square"], sequential=False)
    return tagged.select("event_id", "rejection_reason")


def _lines_tagged(t):
    """Range, duplicates and outliers on one table, each on what the rules before it left."""
    contract = TableContract(
        "lineitem",
        "l_orderkey",
        rules=[
            Within("quantity out of range", {"l_quantity": (2.0, 49.0)}),
            Unique(LINE_KEY, LINE_ORDER),
            Within("discounted too far", {"l_discount": (0.0, 0.09)}),
            NotOutlying(("l_extendedprice",), threshold=1.7),
        ],
    )
    return tag_table(t.lineitem, contract, {})


_LINES_TAGGED = f"""
  a AS (SELECT *, l_quantity < 2 OR l_quantity > 49 AS bad FROM lineitem),
  b AS (SELECT *, NOT bad AND row_number() OVER (PARTITION BY {', '.join(LINE_KEY)}, bad
                ORDER BY {', '.join(LINE_ORDER)}) > 1 AS dup FROM a),
  c AS (SELECT *, NOT bad AND NOT dup AND l_discount > 0.09 AS far FROM b),
  s AS (SELECT avg(l_extendedprice) AS m, stddev_samp(l_extendedprice) AS sd FROM c
        WHERE NOT bad AND NOT dup AND NOT far),
  tagged AS (SELECT c.*, CASE WHEN bad THEN 'quantity out of range'
      WHEN dup THEN 'duplicate primary key' WHEN far THEN 'discounted too far'
      WHEN abs((l_extendedprice - m) / sd) > 1.7 THEN 'zscore_outlier_l_extendedprice' END
      AS rejection_reason FROM c, s)"""


@query(f"WITH {_LINES_TAGGED} SELECT {', '.join(LINE_COLUMNS)}, rejection_reason FROM tagged")
def staged_rules(t):
    return _lines_tagged(t).select(*LINE_COLUMNS, "rejection_reason")


@query(
    f"""WITH {_LINES_TAGGED} SELECT 'lineitem' AS "table", rejection_reason,
          count(*) AS row_count FROM tagged GROUP BY ALL"""
)
def accounting_by_reason(t):
    return rejections_by_reason(_lines_tagged(t), "lineitem")


@query(
    f"""WITH {_LINES_TAGGED} SELECT 'lineitem' AS "table", count(*) AS rows_in,
          count(*) FILTER (WHERE rejection_reason IS NULL) AS rows_cleaned,
          count(*) FILTER (WHERE rejection_reason IS NOT NULL) AS rows_quarantined FROM tagged"""
)
def accounting_totals(t):
    return accounting(_lines_tagged(t), "lineitem")
