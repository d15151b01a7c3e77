"""Operators for preparing training data at scale."""

from .queries import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
