"""Registry of named queries: each entry is a Spark plan over the test
tables plus (when SQL-expressible) the equivalent DuckDB oracle SQL."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def sql_round(expr: str, k: int = 2, precision: int = 18) -> str:
    """SQL twin of ``functions.numeric.round_half_up``."""
    s = float(10 ** k)
    return f"CAST(FLOOR(CAST({expr} AS DOUBLE) * {s} + 0.5) / {s} AS DECIMAL({precision},{k}))"


def sql_ratio(num: str, den: str, k: int = 4, mult: float = 1.0, precision: int = 18) -> str:
    """SQL twin of ``functions.numeric.safe_ratio``."""
    return sql_round(f"({float(mult)} * CAST({num} AS DOUBLE) / NULLIF(CAST({den} AS DOUBLE), 0.0))", k, precision)


def sql_pct(num: str, den: str, k: int = 2) -> str:
    return sql_ratio(num, den, k, 100.0)


def load_all() -> None:
    """Import every module that registers queries."""
    from quaestor.plans import queries, queries_wh, queries_an, queries_ing, queries_forms, queries_more, queries_ops, queries_time, queries_facts  # noqa: F401
