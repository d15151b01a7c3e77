"""Compare a query with its SQL, row by row and in any order."""

from __future__ import annotations

import math
from collections import Counter
from datetime import date, datetime

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')"
        )
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    if isinstance(value, (date, datetime)):
        return value.isoformat()
    return value


def spark_rows(df):
    order = sorted(range(len(df.columns)), key=lambda i: df.columns[i])
    rows = Counter(tuple(_plain(row[i]) for i in order) for row in df.collect())
    return [df.columns[i] for i in order], rows


def sql_rows(connection, sql):
    result = connection.execute(sql)
    names = [column[0] for column in result.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = Counter(tuple(_plain(row[i]) for i in order) for row in result.fetchall())
    return [names[i] for i in order], rows


def difference(df, connection, sql) -> str:
    """Empty if both agree, else what differs."""
    columns, ours = spark_rows(df)
    expected_columns, theirs = sql_rows(connection, sql)
    if columns != expected_columns:
        return f"columns {columns} != {expected_columns}"
    if ours != theirs:
        return (
            f"{sum(ours.values())} rows, expected {sum(theirs.values())}; "
            f"only here {list((ours - theirs).items())[:3]}; "
            f"missing {list((theirs - ours).items())[:3]}"
        )
    return "" if ours else "no rows on either side"
