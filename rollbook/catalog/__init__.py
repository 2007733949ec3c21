"""Registered queries: each operator and plan on the given tables, next to the SQL that states the same result."""
from rollbook.catalog import domain, operators, publishing  # noqa: F401  (they register their queries)
from rollbook.catalog.registry import QUERIES, Query, Tables

__all__ = ["QUERIES", "Query", "Tables"]
