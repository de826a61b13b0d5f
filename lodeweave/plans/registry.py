"""Registry of the engine's queries and of the SQL that each is compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, and its SQL if it has one, under ``name``."""

    def add(f: Query) -> Query:
        _QUERIES[name] = f
        if sql is not None:
            _SQL[name] = sql
        return f

    return add


def queries() -> dict[str, Query]:
    """All registered queries."""
    return _QUERIES


def oracle_sql() -> dict[str, str]:
    """SQL by query name."""
    return _SQL
