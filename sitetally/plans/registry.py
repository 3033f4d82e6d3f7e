"""Registered queries: a callable and, where SQL can say the same, the SQL to check it with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(key: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return register
