"""All queries by name, and their SQL."""

from __future__ import annotations

from medloom.plans import citation_queries, graph_queries, record_queries, registry_queries, sink_queries, source_queries, task_queries, text_queries, triple_queries, vector_queries

_PARTS = (citation_queries, registry_queries, graph_queries, vector_queries, task_queries, text_queries, triple_queries, source_queries, record_queries, sink_queries)
QUERIES: dict = {k: f for part in _PARTS for k, f in part.QUERIES.items()}
ORACLE_SQL: dict = {k: s for part in _PARTS for k, s in part.ORACLE.items()}
