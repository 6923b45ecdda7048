"""Imports every query module so that the registry is complete."""

from lumisift.checks import corpus_queries, descriptor_queries, feature_queries, ingest_queries, search_queries  # noqa: F401
from lumisift.checks.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
