"""Cleaning verbs (P16-P20, A9): what the documented ``transform(df)`` scripts do,
over the whole dataset instead of per 10,000-row batch (D1)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def filter_eq(df: DataFrame, col: str, value) -> DataFrame:
    """Rows where ``col == value`` (nulls never match)."""
    return df.where(F.col(col) == F.lit(value))


def filter_ne(df: DataFrame, col: str, value) -> DataFrame:
    """Rows where ``col != value``; nulls are kept, as pandas ``!=`` keeps them."""
    return df.where(~F.col(col).eqNullSafe(F.lit(value)))


def drop_columns(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Drop columns; names that are absent are ignored."""
    return df.drop(*cols)


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename columns (absent names are ignored)."""
    return df.withColumnsRenamed(dict(mapping))


def computed(df: DataFrame, name: str, expr: Column) -> DataFrame:
    """Add or replace a computed column."""
    return df.withColumn(name, expr)


def dedupe_keep_first(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """One row per key, the first in ``order`` (``drop_duplicates(subset=keys)``).

    ``order`` must be a total order (add a position or every column as a
    tie-break) for the result to be deterministic. Planned as a window with
    ``row_number() = 1``: Spark inserts a partial ``WindowGroupLimit`` before
    the shuffle, so every map task sends at most one row per key and a hot
    key costs one row per task, not all its rows in one task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


# rows of a task that sorts in memory: some 40 to 80 MB
SORT_ROWS = 250_000


def dealt_for_sort(df: DataFrame, keys: list[str], rows: int) -> DataFrame:
    """``df`` of about ``rows`` rows dealt by ``keys`` for a window over them, ``SORT_ROWS`` to a task.

    The window takes this deal as its own shuffle. The planner's would have partitions merged up to the
    target for compressed bytes, several times as large in memory, and a sort on either side: both spill.
    In return all rows of a key come to its task, so it is for keys that few rows share.
    """
    return df.repartition(max(1, -(-rows // SORT_ROWS)), *keys)


def month_at_least(df: DataFrame, col: str, month: str) -> DataFrame:
    """P20: rows whose ``YYYY-MM`` month text is >= ``month``.

    Expressed as a bound on the timestamp itself (same rows for non-null
    values) so that the predicate reaches the Parquet scan as a pushed filter.
    """
    start = F.lit(f"{month}-01 00:00:00").cast("timestamp_ntz")
    return df.where(F.col(col) >= start)
