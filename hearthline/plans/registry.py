"""Registry of named queries: a Spark plan each, and SQL where one exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a plan under ``name`` together with the SQL it must agree with."""

    def register(plan: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = plan
        if sql is not None:
            ORACLES[name] = sql
        return plan

    return register
