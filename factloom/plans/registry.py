"""Registered queries: a Spark callable for each key and, where SQL can express it, the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register the decorated function under its name."""

    def put(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return put


from factloom.plans import document_queries, retrieval_queries, mention_queries, discovery_queries, resolver_queries, vector_queries, graph_queries, timeline_queries, sink_queries, syntax_queries, report_queries, rule_queries, search_queries  # noqa: E402, F401
