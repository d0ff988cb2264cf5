"""Registered queries over the test tables."""

from erpspark.catalog import core_queries, ingest_queries, kpis, marts, primitives, quality_queries, stock_marts  # noqa: F401
from erpspark.catalog.registry import all_checks, all_queries

__all__ = ["all_checks", "all_queries"]
