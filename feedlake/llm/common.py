"""What the text operators share: word rules, table access, written intermediate tables."""

from __future__ import annotations

import contextlib
import ctypes
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.session import scratch_path

# Words are runs of anything but these six ASCII blanks.
BLANKS = " \t\n\x0b\f\r"
BLANK_CLASS = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextlib.contextmanager
def no_shuffles_left(spark: SparkSession):
    """Shuffle files of what runs inside go when it ends, not when the driver happens to collect its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def written(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """``df`` written as Parquet in the shared scratch folder and read back.

    This cuts lineage the recoverable way: a lost executor loses nothing,
    and later reads recompute nothing.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with no_shuffles_left(spark):
        df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, name: str, key: str, among: DataFrame | None = None, compression: str = "snappy") -> DataFrame:
    """``df`` written as a table bucketed by ``key``: joins on it do not shuffle this side. ``among`` has the keys of the rows to write, else all.

    Dealt by bucket first, so that a bucket is one file (else each task would leave one per bucket it holds) and the
    join that picks the rows deals nothing again.
    """
    spark = df.sparkSession
    table_name = f"{name}_{uuid.uuid4().hex[:12]}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = df.repartition(buckets, key)
    if among is not None:
        rows = rows.join(among.hint("merge"), key, "left_semi")
    to = rows.write.format("parquet").bucketBy(buckets, key).option("path", scratch_path(spark, name)).option("compression", compression)
    with no_shuffles_left(spark):
        to.saveAsTable(table_name)
    return spark.table(table_name)


def hand_back() -> None:
    """At the end of a Python task: give freed memory back, as its worker may now wait through other stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim:
        trim(0)


def text_or_empty(col: Column | str = "text") -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def n_words(text: Column) -> Column:
    """Number of words, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def without_blanks(text: Column) -> Column:
    return F.translate(text, BLANKS, "")


def code_points(text: Column) -> Column:
    return F.char_length(text).cast("long")
