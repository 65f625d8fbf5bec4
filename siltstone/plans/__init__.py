"""Queries over the driver's tables, which stand in for the tables of a file store, and their SQL."""

from siltstone.plans import activity, edges, entities, health, streams, trees, versions  # noqa: F401
from siltstone.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
