"""Star joins: a fact with attributes of its dimensions."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..functions.names import named


@dataclass(frozen=True)
class Dimension:
    """Attributes taken from ``table`` by ``key``; ``attributes`` maps source to result name."""

    table: str
    key: str
    attributes: Mapping[str, str]


def enrich(fact: DataFrame, tables: Mapping[str, DataFrame], dimensions: list[Dimension]) -> DataFrame:
    """Left-join each dimension; every fact row comes out once if the keys are unique.

    Each join puts its key first. Dimension keys are unique, so a hot fact key only makes
    one side of a join large, which adaptive execution splits; small dimensions broadcast.
    """
    for d in dimensions:
        picked = [named(source).alias(name) for source, name in d.attributes.items()]
        fact = fact.join(tables[d.table].select(d.key, *picked), d.key, "left")
    return fact
