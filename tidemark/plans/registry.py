"""Registry of named queries and the SQL that checks each of them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register ``fn(spark, sf_dir)`` under ``name``, with the check SQL if there is one."""

    def wrap(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is already registered")
        QUERIES[name] = fn
        if sql is not None:
            CHECKS[name] = sql
        return fn

    return wrap
