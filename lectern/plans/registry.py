"""Registry of the driver's checked queries: one Spark callable and, where SQL can express it, the DuckDB text.

Each callable takes ``(spark, sf_dir)`` and returns a DataFrame over the driver's whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

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


def load_all() -> None:
    """Import every module that registers queries."""
    from lectern.plans import (checks_catalogue, checks_changes, checks_fuzzy, checks_index,  # noqa: F401
                               checks_replies, checks_search, checks_vectors)
