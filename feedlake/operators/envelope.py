"""Envelope operators: dispatch, rejects, routing, latest schema / state.

P1 dispatch on message type, P2 rejected lines, P3 routing by stream,
P4 stream allow-list, P13 latest schema per stream, A10 last STATE.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def _ok():
    return F.col("reject_reason").isNull()


def accepted(env: DataFrame) -> DataFrame:
    """Usable messages (any type)."""
    return env.where(_ok())


def rejects(env: DataFrame) -> DataFrame:
    """Lines set aside, with the reason; never silently dropped."""
    return env.where(~_ok()).select("pos", "line", "reject_reason")


def type_counts(env: DataFrame) -> DataFrame:
    """Number of usable messages per (type, stream)."""
    return accepted(env).groupBy("type", "stream").agg(F.count(F.lit(1)).alias("n_messages"))


def stream_filter(env: DataFrame, streams: Iterable[str] | None) -> DataFrame:
    """Keep only the allowed streams (``None`` keeps all); STATE is kept, and so are
    rejected lines, whatever stream they name, so that they are still counted."""
    if streams is None:
        return env
    allowed = list(streams)
    return env.where(F.col("stream").isin(allowed) | (F.col("type") == "STATE") | ~_ok())


def records(env: DataFrame, stream: str | None = None) -> DataFrame:
    """Usable RECORD messages, of one stream if given."""
    cond = _ok() & (F.col("type") == "RECORD")
    if stream is not None:
        cond = cond & (F.col("stream") == stream)
    return env.where(cond)


def latest_schemas(env: DataFrame) -> DataFrame:
    """The last SCHEMA message of each stream (stream, schema, key_properties)."""
    # the text test runs before the JSON parse, so only candidate lines are parsed
    return last_per_stream(env.where(F.col("line").contains("SCHEMA")).where(_ok() & (F.col("type") == "SCHEMA")))


def last_per_stream(schema_msgs: DataFrame) -> DataFrame:
    """The SCHEMA message with the largest position, per stream (map-side reduced)."""
    last = F.max_by(F.struct("schema", "key_properties"), F.col("pos"))
    return schema_msgs.groupBy("stream").agg(last.alias("s")).select("stream", "s.schema", "s.key_properties")


def to_schema_map(rows) -> dict[str, dict]:
    return {
        r["stream"]: {"schema": json.loads(r["schema"]), "key_properties": r["key_properties"] or []}
        for r in rows
    }


def schema_map(env: DataFrame) -> dict[str, dict]:
    """Latest JSON Schema per stream, on the driver (one row per stream)."""
    return to_schema_map(latest_schemas(env).collect())


def stream_names(env: DataFrame) -> list[str]:
    """Streams named by SCHEMA or RECORD messages, in name order (one row per stream)."""
    s = accepted(env).where(F.col("type").isin("SCHEMA", "RECORD")).select("stream").distinct()
    return sorted(r["stream"] for r in s.collect())


def latest_state(env: DataFrame) -> DataFrame:
    """A10: the value of the last STATE message, as JSON text (one row)."""
    s = env.where(F.col("line").contains("STATE")).where(_ok() & (F.col("type") == "STATE"))
    return s.agg(F.max_by("value", "pos").alias("value"), F.count(F.lit(1)).alias("n_states"))
