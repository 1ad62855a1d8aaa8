"""Publishing landed data so that no failure loses or repeats rows.

*Replacing*: a table is written aside, in a hidden folder of its parent, and
then swapped in by two renames. A write that fails leaves the old table as it
was; a driver lost between the renames leaves both, and the next replacement
(or :func:`recover`) puts the old one back. The renames are metadata
operations on a file system with folders (HDFS, local); on an object store
they copy, and a table format is the better home for the lake.

*Increments* are keyed by run: a run writes its rows below ``_run=<id>``, so
that a repeated attempt of the same run replaces what it left before, and a
new run appends. Readers that ask for :func:`published` rows see only runs
whose success is in the ledger.
"""

from __future__ import annotations

import threading
import uuid
from collections import Counter
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.sources import fs

RUN_COLUMN = "_run"  # readers list folders named ``_x=...`` although other names with ``_`` are hidden
_ASIDE = "_replacing"

# replacements under way by the hidden folder they share; the last one to end deletes it
_LOCK = threading.Lock()
_UNDER_WAY: Counter[str] = Counter()


def _aside(path: str) -> str:
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/{_ASIDE}/{name}"


def recover(spark: SparkSession, path: str) -> bool:
    """Put back the old table of a replacement that was cut off between its renames."""
    if fs.exists(spark, path):
        return False
    kept = fs.glob(spark, f"{_aside(path)}/*/old")
    return bool(kept) and fs.rename(spark, kept[-1], path)


def replace(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Put what ``write(folder)`` leaves in ``folder`` in the place of ``path``.

    One replacement of a table at a time, of its neighbours any number; readers that
    opened the old files go on reading until the swap.
    """
    recover(spark, path)
    shared = _aside(path).rpartition("/")[0]
    work = f"{_aside(path)}/{uuid.uuid4().hex}"
    new, old = f"{work}/new", f"{work}/old"
    with _LOCK:
        _UNDER_WAY[shared] += 1
    try:
        write(new)
        had = fs.exists(spark, path)
        if had and not fs.rename(spark, path, old):
            raise OSError(f"{path} cannot be moved aside")
        if not fs.rename(spark, new, path):
            if had:
                fs.rename(spark, old, path)
            raise OSError(f"{new} cannot be moved to {path}")
    finally:
        try:
            # the old rows go only once others are in their place
            if fs.exists(spark, path) or not fs.exists(spark, old):
                fs.delete(spark, work)
                fs.delete_empty(spark, _aside(path))
        finally:
            with _LOCK:
                _UNDER_WAY[shared] -= 1
                if not _UNDER_WAY[shared]:
                    del _UNDER_WAY[shared]
                    fs.delete_empty(spark, shared)


def withdraw(spark: SparkSession, path: str, run: str, depth: int = 1) -> None:
    """Delete what an earlier attempt of ``run`` left ``depth`` partition levels below ``path``."""
    for folder in fs.glob(spark, path + "/*=*" * depth + f"/{RUN_COLUMN}={run}"):
        fs.delete(spark, folder)


def published(df: DataFrame, ledger: DataFrame) -> DataFrame:
    """Rows of the runs that the ledger knows to have succeeded, without the run column."""
    runs = ledger.where(F.col("status") == "success").select(F.col("run_id").cast("string").alias(RUN_COLUMN)).distinct()
    rows = df.withColumn(RUN_COLUMN, F.col(RUN_COLUMN).cast("string"))
    return rows.join(runs, RUN_COLUMN, "left_semi").drop(RUN_COLUMN)
