"""All registered queries and, for each that SQL can express, the DuckDB statement."""

from textloom.plans import entity_queries, flow_queries, lookup_queries, table_queries, text_queries  # noqa: F401  (they register)
from textloom.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
