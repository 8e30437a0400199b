"""Query catalog: one entry per operator id of SURVEY §2.

Each entry is ``(spark, sf_dir) -> DataFrame`` over the whole test tables,
plus (where SQL can express it) an independent DuckDB text from
``plans.oracle``. ``__spark_entry__`` exposes both dictionaries.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register a query (and its oracle SQL, when SQL can express it)."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return deco


def load_all() -> None:
    """Import the modules that register queries."""
    from sparkretail.plans import (q_marts, q_ml, q_quality, q_serving,  # noqa: F401
                                   q_sources, q_staging)
