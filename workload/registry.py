"""All registered queries and their SQL."""

from __future__ import annotations

from workload import cell_queries, load_queries, source_queries, sync_queries

QUERIES = {}
ORACLE = {}
for module in (source_queries, load_queries, cell_queries, sync_queries):
    source = module.registry
    QUERIES.update(source.queries)
    ORACLE.update(source.oracle)
