"""Whole-table clean-up and text files."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowgate.operators.normalize import normalize, nullify_sentinels, trim_strings
from rowgate.sources import StagingArea, read_csv

from .book import query


@query(
    """SELECT o_orderkey::VARCHAR AS o_orderkey, o_custkey::VARCHAR AS o_custkey, o_orderstatus,
              strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority FROM orders"""
)
def scan_csv_all_string(t):
    path = f"{StagingArea(t.spark).path}/orders-csv"
    t.orders.select(
        "o_orderkey", "o_custkey", "o_orderstatus",
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"), "o_orderpriority",
    ).write.csv(path, header=True)
    return read_csv(t.spark, path)


def _messy_segments(t):
    return t.customer.select(
        "c_custkey",
        F.expr(
            """case c_custkey % 7 when 0 then ' N/A ' when 1 then '-' when 2 then 'Not Provided'
               when 3 then '' when 4 then 'NULL' else concat('  ', c_mktsegment, ' ') end"""
        ).alias("segment"),
        F.concat(F.lit(" "), "c_name", F.lit("  ")).alias("name"),
    )


@query(
    """SELECT c_custkey, CASE WHEN c_custkey % 7 >= 5 THEN c_mktsegment END AS segment,
              c_name AS name FROM customer"""
)
def trim_and_nullify(t):
    return nullify_sentinels(trim_strings(_messy_segments(t)))


@query(
    """SELECT c_custkey, CASE WHEN c_custkey % 7 >= 5 THEN lower(c_mktsegment) END AS segment,
              upper(c_name) AS name,
              CASE WHEN c_custkey % 7 >= 5 THEN length(c_mktsegment) END AS segment_length
       FROM customer"""
)
def normalize_table(t):
    return normalize(
        _messy_segments(t),
        columns={"segment": F.lower, "name": F.upper},
        derived={"segment_length": ("segment", lambda c: F.length(c).cast("bigint"))},
    )
