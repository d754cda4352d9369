"""All queries of the engine by name, and their SQL."""

from __future__ import annotations

from corpuscle.plans import graph_queries, release_queries, serving_queries, source_queries, state_queries, text_queries
from corpuscle.plans.base import Query

MODULES = (text_queries, graph_queries, state_queries, serving_queries, release_queries, source_queries)


def queries() -> dict[str, Query]:
    return {f.__name__: f for m in MODULES for f in m.QUERIES}


def oracle_sql() -> dict[str, str]:
    return {k: v for m in MODULES for k, v in m.SQL.items()}
