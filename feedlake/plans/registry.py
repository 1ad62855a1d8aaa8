"""Registry of named queries and their DuckDB oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}
# builders of inputs derived from the driver tables (feeds, CSV exports); the bench runs them untimed
PREPARE: list[Callable[[SparkSession, str], object]] = []


def prepares(fn):
    PREPARE.append(fn)
    return fn


def query(key: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``key``, with its oracle SQL if any."""

    def deco(fn: QueryFn) -> QueryFn:
        if key in QUERIES:
            raise KeyError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql.strip()
        return fn

    return deco


def load_all() -> None:
    """Import every query module so that the registry is full."""
    from feedlake.plans import (  # noqa: F401
        q_aggregate,
        q_clean,
        q_feed,
        q_land,
        q_ledger,
        q_sources,
        q_transform,
    )
