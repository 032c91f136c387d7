"""Registry of named queries: a Spark builder and, where SQL can say it, an
independent DuckDB oracle text over the same parquet tables.

Builders take ``(spark, sf_dir)`` and return a lazy DataFrame.  Computed
columns carry the same names in both texts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn`` under ``name`` with an optional oracle text."""
    def deco(fn: Builder) -> Builder:
        if name in QUERIES:
            raise KeyError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    from shelfwise.plans import (q_gold, q_landing, q_quality, q_silver,  # noqa: F401
                                 q_snapshot, q_tables)
