"""The operators run on the test tables, each with the SQL that must agree with it."""

from . import (  # noqa: F401
    clinical, clinical_dirty, files, oddities, quality, rejections, relations, runs, scalars, tables,
)
from .book import ORACLES, QUERIES, Tables

__all__ = ["ORACLES", "QUERIES", "Tables"]
