"""Named queries, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from framelake.plans.views import with_views

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None, recursive: bool = False) -> Callable[[Query], Query]:
    """Register a query; without `sql` it is compared with brute force in the tests instead."""
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = with_views(sql, recursive)
        return fn
    return register
