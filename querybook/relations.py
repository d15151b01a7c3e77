"""Foreign keys, cascades and the joined fact."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowgate.operators.enrich import Dimension, enrich
from rowgate.operators.references import tag_orphans
from rowgate.operators.rules import Required, Within
from rowgate.operators.split import clean_rows, quarantined_rows
from rowgate.plans.contract import References, TableContract, Unique
from rowgate.plans.lifecycle import account, tag_tables
from rowgate.sources import StagingArea

from .book import query
from .rejections import LINE_COLUMNS, LINE_KEY, LINE_ORDER

# Every 50th order has no customer, every 13th one names a customer that does not exist.
_CUSTOMER_OF = """CASE WHEN o_orderkey % 50 = 0 THEN NULL
                       WHEN o_orderkey % 13 = 0 THEN o_custkey + 1000000000
                       ELSE o_custkey END"""
_LINE_LIST = ", ".join(LINE_COLUMNS)


def _orders(t):
    return t.orders.select("o_orderkey", F.expr(_CUSTOMER_OF).alias("customer"), "o_totalprice")


def _orders_tagged(t):
    return tag_orphans(
        _orders(t), "customer", t.customer, "fk_customer not in customer", parent_key="c_custkey"
    )


_ORDERS = f"(SELECT o_orderkey, {_CUSTOMER_OF} AS customer, o_totalprice FROM orders)"


@query(f"SELECT * FROM {_ORDERS} WHERE customer IN (SELECT c_custkey FROM customer)")
def fk_valid(t):
    return clean_rows(_orders_tagged(t))


@query(
    f"""SELECT *, 'fk_customer not in customer' AS rejection_reason FROM {_ORDERS} o
        WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o.customer)"""
)
def fk_orphans(t):
    return quarantined_rows(_orders_tagged(t))


@query(
    f"""SELECT {_LINE_LIST}, CASE
          WHEN l_partkey % 17 = 0 THEN 'fk_order not in orders'
          WHEN l_suppkey % 7 = 0 THEN 'fk_supplier not in supplier' END AS rejection_reason
        FROM lineitem"""
)
def fk_chain(t):
    """Two parents in order; the first missing one names the reason."""
    lines = t.lineitem.select(
        *LINE_COLUMNS,
        F.expr("if(l_partkey % 17 = 0, l_orderkey + 1000000000000, l_orderkey)").alias("order"),
        F.expr("if(l_suppkey % 7 = 0, null, l_suppkey)").alias("supplier"),
    )
    lines = tag_orphans(lines, "order", t.orders, "fk_order not in orders", "o_orderkey")
    lines = tag_orphans(lines, "supplier", t.supplier, "fk_supplier not in supplier", "s_suppkey")
    return lines.select(*LINE_COLUMNS, "rejection_reason")


_CASCADE = {
    "customer": TableContract(
        "customer", "c_custkey", rules=[Within("in debt", {"c_acctbal": (0.0, 1e12)})]
    ),
    "orders": TableContract(
        "orders",
        "o_orderkey",
        rules=[
            Required("null customer", "o_custkey"),
            References("o_custkey", "customer", "c_custkey"),
        ],
    ),
    "lineitem": TableContract(
        "lineitem",
        "l_orderkey",
        rules=[Unique(LINE_KEY, LINE_ORDER), References("l_orderkey", "orders", "o_orderkey")],
    ),
}


def _cascade(t):
    raw = {"customer": t.customer, "orders": t.orders, "lineitem": t.lineitem}
    return tag_tables(raw, _CASCADE, StagingArea(t.spark))


_CASCADE_SQL = f"""
  c AS (SELECT *, CASE WHEN c_acctbal < 0 THEN 'in debt' END AS why FROM customer),
  o AS (SELECT orders.*, CASE WHEN c.c_custkey IS NULL
               THEN 'fk_o_custkey not in customer' END AS why
        FROM orders LEFT JOIN c ON c_custkey = o_custkey AND c.why IS NULL),
  l AS (SELECT x.*, CASE WHEN rn > 1 THEN 'duplicate primary key' WHEN o.o_orderkey IS NULL
               THEN 'fk_l_orderkey not in orders' END AS why
        FROM (SELECT *, row_number() OVER (PARTITION BY {', '.join(LINE_KEY)}
                     ORDER BY {', '.join(LINE_ORDER)}) AS rn FROM lineitem) x
        LEFT JOIN o ON o_orderkey = l_orderkey AND o.why IS NULL)"""


@query(f"WITH {_CASCADE_SQL} SELECT {_LINE_LIST}, why AS rejection_reason FROM l")
def fk_cascade(t):
    return _cascade(t)["lineitem"].select(*LINE_COLUMNS, "rejection_reason")


@query(
    f"""WITH {_CASCADE_SQL},
        u AS (SELECT 'customer' AS "table", why FROM c UNION ALL SELECT 'orders', why FROM o
              UNION ALL SELECT 'lineitem', why FROM l)
        SELECT "table", count(*) AS rows_in, count(*) FILTER (WHERE why IS NULL) AS rows_cleaned,
               count(*) FILTER (WHERE why IS NOT NULL) AS rows_quarantined FROM u GROUP BY ALL"""
)
def cascade_accounting(t):
    return account(_cascade(t))


GOLD_DIMENSIONS = [
    Dimension("customer", "custkey", {"name": "customer_name", "mktsegment": "segment"}),
    Dimension("supplier", "suppkey", {"name": "supplier_name", "nationkey": "supplier_nation"}),
]


def star(t):
    """The order lines as a fact with customers and suppliers as dimensions.

    Some lines name a supplier that does not exist, and stay without its attributes.
    """
    fact = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.expr("if(l_partkey % 19 = 0, -1, l_suppkey)").alias("suppkey"),
        F.col("o_custkey").alias("custkey"),
        "l_orderkey", "l_linenumber", "l_extendedprice",
    )
    customer = t.customer.select(
        F.col("c_custkey").alias("custkey"), F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("mktsegment"),
    )
    supplier = t.supplier.select(
        F.col("s_suppkey").alias("suppkey"), F.col("s_name").alias("name"),
        F.col("s_nationkey").alias("nationkey"),
    )
    return {"lines": fact, "customer": customer, "supplier": supplier}


GOLD_SQL = """
  SELECT f.suppkey, f.custkey, l_orderkey, l_linenumber, l_extendedprice,
         c_name AS customer_name, c_mktsegment AS segment,
         s_name AS supplier_name, s_nationkey AS supplier_nation
  FROM (SELECT CASE WHEN l_partkey % 19 = 0 THEN -1 ELSE l_suppkey END AS suppkey,
               o_custkey AS custkey, l_orderkey, l_linenumber, l_extendedprice
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey) f
  LEFT JOIN customer ON c_custkey = f.custkey LEFT JOIN supplier ON s_suppkey = f.suppkey"""


@query(GOLD_SQL)
def gold_fact(t):
    tables = star(t)
    return enrich(tables["lines"], tables, GOLD_DIMENSIONS)
