"""Operators as named queries over the driver tables, with an SQL statement to compare with."""

from . import assessment, counters, outliers, pipelines, regions, scoring, spatial, storage  # noqa: F401  (register queries)
from .registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
