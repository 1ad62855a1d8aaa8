"""Report aggregates and ordering.

All are grouped aggregates that Spark plans as partial (map-side) plus
final hash aggregation, so a hot group is reduced to one row per map task
before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.functions import month_text, to_day


def headcount(df: DataFrame, keys: list[str], id_col: str, measure: str) -> DataFrame:
    """A2: count of ids, min and max of a measure per group; rows with a null key are
    left out, as pandas ``groupby`` does, and ``count`` skips null ids."""
    keyed = df
    for k in keys:
        keyed = keyed.where(F.col(k).isNotNull())
    return keyed.groupBy(*keys).agg(
        F.count(id_col).alias("customer_count"),
        F.min(measure).alias("min_balance"),
        F.max(measure).alias("max_balance"),
    )


def daily_events(df: DataFrame, ts: str, kind: str, user: str, approx: bool = False) -> DataFrame:
    """A3: events and distinct users per (day, kind); ``approx`` uses HyperLogLog++."""
    users = F.approx_count_distinct(user) if approx else F.count_distinct(user)
    return df.groupBy(to_day(ts).alias("day"), F.col(kind)).agg(
        F.count(F.lit(1)).alias("events"), users.alias("users")
    )


def monthly_sum(df: DataFrame, ts: str, measure: str, name: str) -> DataFrame:
    """A4: sum per ``YYYY-MM`` month, newest month first."""
    return (
        df.groupBy(month_text(ts).alias("month"))
        .agg(F.round(F.sum(measure), 2).alias(name))
        .orderBy(F.col("month").desc())
    )


def distribution(df: DataFrame, key: str) -> DataFrame:
    """Rows per value, most frequent first."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), F.col(key))


def top_k(df: DataFrame, k: int, order: list[Column]) -> DataFrame:
    """O3: the first ``k`` rows in ``order``."""
    return df.orderBy(*order).limit(k)
