"""The registered queries and their SQL twins, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
TWINS: dict[str, str] = {}


def registered(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with its SQL if it has one; its name is the
    function's unless given."""

    def add(query: Query) -> Query:
        key = name or query.__name__
        if key in QUERIES:
            raise ValueError(f"two queries named {key}")
        QUERIES[key] = query
        if sql is not None:
            TWINS[key] = sql
        return query

    return add
