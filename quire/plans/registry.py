"""Registry of named queries (Spark) and their DuckDB oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quire.plans.sqlfrag import with_bindings

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None, bindings: tuple[str, ...] = ()):
    """Register a Spark query under ``name``; ``sql`` is its DuckDB oracle
    (omitted for operators with no SQL equivalent: a property test covers them)."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = with_bindings(list(bindings), sql) if bindings else sql.strip()
        return fn

    return deco
