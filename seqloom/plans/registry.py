"""Registry of named queries with their checking SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from seqloom.plans.domain import Domain, with_tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(domain) -> DataFrame`` as ``name``; ``sql`` may use the domain tables."""

    def add(fn: Callable[[Domain], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = lambda spark, folder: fn(Domain(spark, folder))
        if sql is not None:
            SQL[name] = with_tables(sql)
        return fn

    return add
