"""Per-stream decode of an envelope: the feed -> tables step of a run."""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlake.operators import envelope as E
from feedlake.operators.decode import REST, Decoded, decode, infer_fields, json_schema_fields, raw_struct
from feedlake.sources.feed import feed_lines, messages, parse_once, read_feed


def decode_stream(env: DataFrame, stream: str, schemas: dict | None = None, **policy) -> Decoded:
    """Decode the records of ``stream`` with its latest SCHEMA (P13), or infer one."""
    schemas = E.schema_map(env) if schemas is None else schemas
    recs = E.records(env, stream)
    if stream in schemas:
        fields = json_schema_fields(schemas[stream]["schema"])
    else:
        fields = infer_fields(recs)
    return decode(recs, fields, **policy)


# routes of the staged envelope; those of records carry a prefix, so no stream name can meet the others
REJECTS = "rejects"
CONTROL = "control"


def route_of(stream: str) -> str:
    return f"stream-{stream}"



def stage_envelope(env: DataFrame, path: str, rejected: Observation | None = None) -> DataFrame:
    """Write the envelope once, partitioned by ``route``: one folder per stream for
    RECORD messages, one for rejected lines and one for SCHEMA / STATE messages.
    Every later step reads only its folder (partition pruning), so the feed text
    is parsed a single time however many streams it carries.

    Rows are dealt by route before the write, large routes to several tasks and small
    ones together (``rebalance``), so that the number of files follows the size of the
    data, not tasks x streams. ``rejected`` observes the number of rejected lines (``n``)."""
    route = (
        F.when(F.col("reject_reason").isNotNull(), F.lit(REJECTS))
        .when(F.col("type") == "RECORD", F.concat(F.lit(route_of("")), "stream"))
        .otherwise(F.lit(CONTROL))
    )
    bad = F.col("reject_reason").isNotNull()
    out = env.select(
        route.alias("route"), "pos", "type", "stream", "record", "schema", "key_properties", "value",
        F.when(bad, F.col("line")).alias("line"), "reject_reason",
    )
    if rejected is not None:
        out = out.observe(rejected, F.count_if(F.col("route") == REJECTS).alias("n"))
    out.hint("rebalance", F.col("route")).write.mode("overwrite").partitionBy("route").parquet(path)
    # the schema is given, so that routes stay text
    schema = T.StructType([*out.drop("route").schema.fields, T.StructField("route", T.StringType())])
    return env.sparkSession.read.schema(schema).parquet(path)


def staged_streams(staged: DataFrame) -> list[str]:
    """Streams with at least one record: the partition folders of the staging, as the file index has them."""
    routes = {unquote(m[1]) for m in (re.search(r"/route=([^/]*)/", f) for f in staged.inputFiles()) if m}
    return sorted(unquote(r).removeprefix(route_of("")) for r in routes if unquote(r) not in (REJECTS, CONTROL))


def staged_schemas(staged: DataFrame) -> dict[str, dict]:
    """Latest SCHEMA per stream, read from the small control folder of the staging."""
    msgs = staged.where((F.col("route") == CONTROL) & (F.col("type") == "SCHEMA"))
    return E.to_schema_map(E.last_per_stream(msgs).collect())


def decode_staged(staged: DataFrame, stream: str, schemas: dict, **policy) -> Decoded:
    part = staged.where(F.col("route") == route_of(stream))
    fields = json_schema_fields(schemas[stream]["schema"]) if stream in schemas else infer_fields(part)
    return decode(part, fields, **policy)


def decode_all(env: DataFrame, stage: str | None = None, **policy) -> dict[str, Decoded]:
    """Every stream of the feed, decoded (streams with a SCHEMA and no rows included).

    With ``stage`` (a scratch folder) the envelope is routed once by a partitioned
    write instead of one filtered scan of the feed per stream."""
    if stage is None:
        schemas = E.schema_map(env)
        return {s: decode_stream(env, s, schemas, **policy) for s in E.stream_names(env)}
    staged = stage_envelope(env, stage)
    schemas = staged_schemas(staged)
    present = staged_streams(staged)
    out = {s: decode_staged(staged, s, schemas, **policy) for s in present}
    spark = env.sparkSession
    for s in set(schemas) - set(present):  # announced, no rows
        empty = spark.createDataFrame([], "pos struct<n:bigint>, record string")
        out[s] = decode(empty, json_schema_fields(schemas[s]["schema"]), **policy)
    return dict(sorted(out.items()))


def decode_feed(spark: SparkSession, path: str, stream: str, **policy) -> Decoded:
    """P6 on a feed file: each RECORD line of ``stream`` is parsed once, straight into
    its declared fields as text, then cast. The stream's SCHEMA is looked up first
    with a scan that only parses lines mentioning ``SCHEMA``."""
    env = read_feed(spark, path)
    schemas = E.schema_map(env)
    if stream in schemas:
        fields = json_schema_fields(schemas[stream]["schema"])
    else:
        fields = infer_fields(E.records(env, stream))
    if any(f.kind == REST for f in fields):  # needs the record's own text
        return decode(E.records(env, stream), fields, **policy)
    shape = T.StructType([
        T.StructField("type", T.StringType()),
        T.StructField("stream", T.StringType()),
        T.StructField("record", raw_struct(fields)),
        T.StructField("_corrupt_record", T.StringType()),
    ])
    e = parse_once(feed_lines(spark, path), shape)
    recs = e.where(
        (F.col("e.type") == "RECORD") & (F.col("e.stream") == stream)
        & F.col("e._corrupt_record").isNull() & F.col("e.record").isNotNull()
    ).select("pos", "line", F.col("e.record").alias("record"))
    keep = policy.pop("keep", ())
    dec = decode(recs, fields, record_col="record", text_col="line", keep=keep, **policy)
    # RECORD lines of the stream without a usable record: few, so they are parsed again to say why
    odd = F.col("e._corrupt_record").isNotNull() | ((F.col("e.type") == "RECORD") & F.col("e.record").isNull())
    odd = messages(e.where(odd).select("pos", "line"))
    odd = odd.where((F.col("type") == "RECORD") & (F.col("stream") == stream) & F.col("reject_reason").isNotNull())
    odd = odd.select(*keep, F.col("line").alias("record"), F.array("reject_reason").alias("errors"))
    return Decoded(dec.rows, dec.rejects.unionByName(odd), dec.fields)
