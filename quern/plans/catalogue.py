"""All queries of the core, and the SQL of those that SQL can state."""

from __future__ import annotations

from quern.plans import nested_queries, reference_queries

_MODULES = (reference_queries, nested_queries)
QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
ORACLE_SQL = {name: sql for module in _MODULES for name, sql in module.ORACLE_SQL.items()}
FLAGSHIP = reference_queries.FLAGSHIP
