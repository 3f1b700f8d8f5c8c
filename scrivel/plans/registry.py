"""All queries by name."""

from __future__ import annotations

from scrivel.plans import element_queries, layout_queries, record_queries, statement_queries

QUERIES = (
    record_queries.QUERIES
    | statement_queries.QUERIES
    | layout_queries.QUERIES
    | element_queries.QUERIES
)
