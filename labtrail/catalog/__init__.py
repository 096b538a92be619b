"""Runnable queries on the star-schema tables, each with the SQL that says what it must return."""

from labtrail.catalog import batches, checks, intake, mapping, outputs, plans, runs, scope  # noqa: F401
from labtrail.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
