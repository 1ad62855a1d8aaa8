"""Bookmarks and incremental runs.

A bookmark is one row per stream: (stream, key_column, value) with the
value as text. The commit order of a run is data -> ledger -> bookmark,
and the bookmark is only written after the data write succeeded (I3).
Saved bookmarks are appended with a version and the newest of each stream
counts: a save never touches what other streams or earlier runs left, so a
run that dies while saving loses nothing. The incremental filter ``key > bookmark`` is applied as a literal so that
it reaches the Parquet (or JDBC) scan as a pushed filter.

A feed has many streams, so its bookmarks (taken from the landed rows or from the feed's STATE) are joined to the
envelope instead: records that are not newer than their stream's bookmark are dropped before anything is staged.
"""

from __future__ import annotations

import json
import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlake.functions import qcol
from feedlake.sources import fs

BOOKMARK_DDL = "stream string, key_column string, value string"
KINDED_DDL = f"{BOOKMARK_DDL}, kind string"
SAVED_DDL = f"{KINDED_DDL}, version bigint"
# bookmarks that are broadcast to the envelope, at most; more are joined by a shuffle
SMALL = 10_000
# fixed value: text form of timestamp bookmarks
TS_TEXT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def _as_text(c: Column, dt: T.DataType) -> Column:
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(c, TS_TEXT)
    return c.cast("string")


def largest(df: DataFrame, key: str) -> Column:
    """The maximum of ``key`` as bookmark text (an aggregate)."""
    return _as_text(F.max(qcol(key)), df.schema[key].dataType)


def kind_of(df: DataFrame, key: str) -> str:
    """How values of ``key`` compare when they are text: as ``number``, ``time`` or ``text``."""
    dt = df.schema[key].dataType
    if isinstance(dt, T.NumericType):
        return "number"
    return "time" if isinstance(dt, (T.TimestampType, T.TimestampNTZType, T.DateType)) else "text"


def bookmark_of(df: DataFrame, stream: str, key: str) -> DataFrame:
    """The bookmark a run leaves for ``stream``: the maximum of ``key`` (one row)."""
    return df.agg(F.lit(stream).alias("stream"), F.lit(key).alias("key_column"), largest(df, key).alias("value"))


def save(bookmarks: DataFrame, path: str) -> None:
    """K9: store the streams' bookmarks (call only after the data commit succeeded)."""
    kind = F.col("kind") if "kind" in bookmarks.columns else F.lit(None).cast("string")
    out = bookmarks.select("stream", "key_column", "value", kind.alias("kind"), F.lit(time.time_ns()).alias("version"))
    out.coalesce(1).write.mode("append").parquet(path)


def load(spark: SparkSession, path: str, kinds: bool = False) -> DataFrame:
    """The newest bookmark of each stream, with its kind if asked for; no rows when nothing was saved."""
    if not fs.exists(spark, path):
        return spark.createDataFrame([], KINDED_DDL if kinds else BOOKMARK_DDL)
    newest = F.max_by(F.struct("key_column", "value", "kind"), F.coalesce("version", F.lit(0))).alias("b")
    saved = spark.read.schema(SAVED_DDL).parquet(path).groupBy("stream").agg(newest)
    return saved.select("stream", "b.key_column", "b.value", *(["b.kind"] if kinds else []))


def from_state(state: str | None, schemas: dict[str, dict]) -> list[tuple[str, str, str, str]]:
    """Bookmarks (stream, key, value, kind) in a feed's STATE value (JSON text, one per run).

    Understood: ``{"bookmarks": {stream: mark}}`` or the streams at the top, a mark being ``{"replication_key": k,
    "replication_key_value": v}``, ``{k: v}`` with one plain value, or a plain value where the stream has one
    key property. Anything else is opaque and gives no bookmark.
    """
    try:
        value = json.loads(state or "null")
    except ValueError:
        return []
    marks = value.get("bookmarks", value) if isinstance(value, dict) else None
    plain = lambda v: isinstance(v, (int, float, str)) and not isinstance(v, bool)
    out = []
    for stream, mark in (marks if isinstance(marks, dict) else {}).items():
        about = schemas.get(stream, {})
        if isinstance(mark, dict) and "replication_key_value" in mark:
            found = [(mark.get("replication_key"), mark["replication_key_value"])]
        elif isinstance(mark, dict):
            found = list(mark.items())
        else:
            found = [(k, mark) for k in about.get("key_properties", [])]
        found = [(k, v) for k, v in found if isinstance(k, str) and plain(v)]
        if len(found) == 1:
            key, v = found[0]
            declared = (about.get("schema") or {}).get("properties") or {}
            time_like = str((declared.get(key) or {}).get("format", "")).startswith("date")
            kind = "time" if time_like else "text" if isinstance(v, str) else "number"
            out.append((stream, key, v if isinstance(v, str) else json.dumps(v), kind))
    return out


def newer_records(env: DataFrame, marks: DataFrame) -> DataFrame:
    """J3/I1 on a feed: the envelope without records that are not newer than their stream's bookmark.

    ``marks`` are the streams' bookmarks with kinds. A record without a comparable key value is
    above no bookmark and below none: it is rejected (``bookmark_key``), so that it is neither
    lost nor landed again by every run.
    """
    marks = marks.select(F.col("stream").alias("_stream"), F.col("key_column").alias("_key"), F.col("value").alias("_old"), F.col("kind").alias("_kind"))
    if marks.count() <= SMALL:
        marks = F.broadcast(marks)
    known = (F.col("type") == "RECORD") & F.col("reject_reason").isNull()
    rows = env.join(marks, known & (F.col("stream") == F.col("_stream")), "left")
    # records of other streams are not parsed
    now = F.when(F.col("_stream").isNotNull(), F.element_at(F.from_json("record", "map<string,string>"), F.col("_key")))
    rows = rows.withColumn("_now", now)

    def above(cast):
        return cast("_now") > cast("_old")

    number = F.coalesce(above(lambda c: F.expr(f"try_cast({c} AS decimal(38,9))")), above(lambda c: F.expr(f"try_cast({c} AS double)")))
    moment = above(lambda c: F.try_to_timestamp(F.col(c)))
    text = above(F.col)
    newer = F.when(F.col("_kind") == "number", number).when(F.col("_kind") == "time", moment).when(F.col("_kind") == "text", text).otherwise(F.coalesce(number, text))
    rows = rows.withColumn("_newer", newer)
    free = F.col("_stream").isNull()
    rows = rows.where(free | F.col("_newer").isNull() | F.col("_newer"))
    reason = F.when(~free & F.col("_newer").isNull(), F.lit("bookmark_key")).otherwise(F.col("reject_reason"))
    return rows.select(*(reason.alias(c) if c == "reject_reason" else F.col(c) for c in env.columns))


def value_for(bookmarks: DataFrame, stream: str) -> str | None:
    """The bookmark of one stream, on the driver (at most one row)."""
    rows = bookmarks.where(F.col("stream") == stream).select("value").limit(1).collect()
    return rows[0]["value"] if rows else None


def has_null_keys(df: DataFrame, key: str) -> bool:
    """Whether any row has no key: such rows are above no bookmark and would never be read again."""
    return df.schema[key].nullable and not df.where(qcol(key).isNull()).select(F.lit(1)).isEmpty()


def newer_than(df: DataFrame, key: str, value: str | None) -> DataFrame:
    """Rows strictly newer than the bookmark (all rows when there is none)."""
    if value is None:
        return df
    dt = df.schema[key].dataType
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        bound = F.to_timestamp_ntz(F.lit(value), F.lit(TS_TEXT)) if isinstance(dt, T.TimestampNTZType) \
            else F.to_timestamp(F.lit(value), TS_TEXT)
    else:
        bound = F.lit(value).cast(dt)
    return df.where(F.col(key) > bound)


def incremental(
    df: DataFrame, stream: str, key: str, bookmarks: DataFrame, full: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Rows to land and the bookmark to save after they land.

    ``full`` ignores the stored bookmark (forced full run) but still
    produces a new one, as the reference saves state even then (I3).
    """
    old = None if full else value_for(bookmarks, stream)
    rows = newer_than(df, key, old)
    new = bookmark_of(rows, stream, key)
    if old is not None:  # nothing new: the bookmark stays where it was
        new = new.withColumn("value", F.coalesce(F.col("value"), F.lit(old)))
    return rows, new
