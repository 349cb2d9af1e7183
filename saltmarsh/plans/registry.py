"""Registered queries: a Spark plan over the tables and, where SQL can say it, the same in DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return register


def rnd(expr: str, digits: int = 6) -> str:
    """SQL twin of ``functions.numbers.tidy``."""
    scale = f"CAST(1e{digits} AS DOUBLE)"
    return f"floor(CAST({expr} AS DOUBLE) * {scale} + 0.5) / {scale}"
