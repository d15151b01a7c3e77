"""Columns by their exact names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def named(name: str) -> Column:
    """The column of this name, also where the name holds dots or backticks."""
    return F.col("`" + name.replace("`", "``") + "`")


def own_name(df: DataFrame, name: str) -> str:
    """The name as the table writes it, letter case as ``spark.sql.caseSensitive`` wants; raises if absent."""
    if name in df.columns:
        return name
    if df.sparkSession.conf.get("spark.sql.caseSensitive", "false") != "true":
        found = [c for c in df.columns if c.lower() == name.lower()]
        if len(found) == 1:
            return found[0]
    raise ValueError(f"no column {name!r} among {df.columns}")
