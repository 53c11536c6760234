"""Registered queries: every operator on the test tables, with the SQL that gives the same result."""

from tripmill.plans import batch, declared_sources, lookups, stored, streams, windows  # noqa: F401  (they register)
from tripmill.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
