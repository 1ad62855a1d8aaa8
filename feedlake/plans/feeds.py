"""Message feeds derived by Spark from the driver tables (test and bench inputs).

A feed is written as text under one directory, one sub-directory per
*segment* (``seg0000``, ``seg0001`` ...). Path order is feed order, so the
position read back by :func:`feedlake.sources.feed.feed_lines` puts all
SCHEMA lines of segment 0 before the records of segment 1, and so on.

Feeds are built once per (tables, variant) and reused: the directory name
carries a fingerprint of the source files, so a changed table gives a new
feed. Every line is made by Spark expressions (``to_json`` over the table),
so building a feed is one distributed pass over the table.
"""

from __future__ import annotations

import hashlib
import json
import threading
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.functions import qcol
from feedlake.operators.decode import spark_to_json_schema
from feedlake.session import scratch_root
from feedlake.sources import fs

_BUILD_LOCK = threading.Lock()

# fixed value: Spark's default JSON timestamp format keeps only milliseconds
TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
JSON_OPTS = {"timestampNTZFormat": TS_FORMAT, "timestampFormat": TS_FORMAT + "XXX"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _lines(spark: SparkSession, texts: list[str]) -> DataFrame:
    return spark.createDataFrame([(t,) for t in texts], "value string")


def schema_line(stream: str, schema: dict, key_properties: list[str] | None = None) -> str:
    return json.dumps(
        {"type": "SCHEMA", "stream": stream, "schema": schema, "key_properties": key_properties or []}
    )


def record_lines(df: DataFrame, stream: str, record: Column | None = None) -> DataFrame:
    """RECORD lines: ``to_json`` of (type, stream, record) per row."""
    rec = record if record is not None else F.struct(*[qcol(c) for c in df.columns])
    msg = F.struct(F.lit("RECORD").alias("type"), F.lit(stream).alias("stream"), rec.alias("record"))
    return df.select(F.to_json(msg, JSON_OPTS).alias("value"))


def state_line(df: DataFrame, stream: str, key: str) -> DataFrame:
    """One STATE line whose bookmark is the maximum of ``key`` (an aggregate of the table)."""
    value = F.struct(F.struct(F.struct(F.max(key).alias(key)).alias(stream)).alias("bookmarks"))
    msg = F.struct(F.lit("STATE").alias("type"), value.alias("value"))
    return df.agg(F.to_json(msg, JSON_OPTS).alias("value"))


# lines of a feed file: it is compressed, so one task reads it whole, and many files keep all tasks busy
FILE_LINES = 50_000


def write_segments(segments: list[DataFrame], path: str) -> str:
    for i, seg in enumerate(segments):
        seg.select("value").write.mode("overwrite").options(compression="gzip", maxRecordsPerFile=FILE_LINES).text(f"{path}/seg{i:04d}")
    return path


def derived(spark: SparkSession, sf_dir: str, name: str, tables: list[str], write, code_of=None) -> str:
    """Folder of input data derived by Spark from driver tables, written once by
    ``write(path)`` and reused. The key covers the input files and the code that
    derives them, so a changed table or rule gives a new folder."""
    paths = [f"{sf_dir.rstrip('/')}/{t}.parquet" for t in tables]
    code = hashlib.sha1(Path(code_of or __file__).read_bytes()).hexdigest()
    key = hashlib.sha1(f"{name}|{code}|{fs.source_fingerprint(spark, paths)}".encode()).hexdigest()[:16]
    path = f"{scratch_root(spark)}/feedlake/derived/{name}-{key}"
    with _BUILD_LOCK:
        if fs.exists(spark, f"{path}/_READY"):
            return path
        # build aside, then publish by rename: a reader never sees a half-built folder,
        # and a concurrent builder elsewhere simply loses the race
        tmp = f"{path}.building-{uuid.uuid4().hex[:8]}"
        write(tmp)
        fs.write_bytes(spark, f"{tmp}/_READY", b"ok")
        if not fs.exists(spark, path):
            fs.rename(spark, tmp, path)
    return path if fs.exists(spark, f"{path}/_READY") else tmp


def fixture(spark: SparkSession, sf_dir: str, variant: str) -> str:
    """Directory of feed ``variant`` built from the tables in ``sf_dir`` (built on first use)."""
    build, tables = VARIANTS[variant]
    return derived(spark, sf_dir, f"feed-{variant}", tables, lambda path: write_segments(build(spark, sf_dir), path))


# ------------------------------------------------------------------ variants


def _clean(name: str, key: str, key_props: list[str]):
    def build(spark, sf_dir):
        df = table(spark, sf_dir, name)
        head = _lines(spark, [schema_line(name, spark_to_json_schema(df.schema), key_props)])
        return [head, record_lines(df, name), state_line(df, name, key)]

    return build


def _events_objects(spark, sf_dir):
    """events with ``props`` as a JSON object, and one STATE per day after the records."""
    ev = table(spark, sf_dir, "events")
    schema = spark_to_json_schema(ev.schema)
    schema["properties"]["props"] = {"type": ["null", "object"]}
    rec = F.struct(*[F.expr("parse_json(props)").alias(c) if c == "props" else F.col(c) for c in ev.columns])
    day = F.to_date("ts")
    state_val = F.struct(F.struct(F.struct(F.max("ts").alias("ts")).alias("events")).alias("bookmarks"))
    states = (
        ev.groupBy(day.alias("day"))
        .agg(F.to_json(F.struct(F.lit("STATE").alias("type"), state_val.alias("value")), JSON_OPTS).alias("value"))
        .orderBy("day")
    )
    head = _lines(spark, [schema_line("events", schema, ["event_id"])])
    return [head, record_lines(ev, "events", rec), states]


def _events_dirty(spark, sf_dir):
    """FIXTURES 4.2: by event_id % 10: 0 malformed, 1 JSON array, 2 unknown type, 3 no stream."""
    ev = table(spark, sf_dir, "events")
    head = _lines(spark, [schema_line("events", spark_to_json_schema(ev.schema), ["event_id"])])
    rec = F.struct(*ev.columns)
    good = F.to_json(F.struct(F.lit("RECORD").alias("type"), F.lit("events").alias("stream"), rec.alias("record")),
                     JSON_OPTS)
    other = F.to_json(
        F.struct(F.lit("ACTIVATE_VERSION").alias("type"), F.lit("events").alias("stream"), F.lit(1).alias("version")),
        JSON_OPTS,
    )
    no_stream = F.to_json(F.struct(F.lit("RECORD").alias("type"), rec.alias("record")), JSON_OPTS)
    r = F.col("event_id") % 10
    line = (
        F.when(r == 0, F.expr("substring(g, 1, length(g) - 1)"))
        .when(r == 1, F.concat(F.lit("["), F.col("g"), F.lit("]")))
        .when(r == 2, F.col("o"))
        .when(r == 3, F.col("n"))
        .otherwise(F.col("g"))
    )
    body = ev.select(*ev.columns, good.alias("g"), other.alias("o"), no_stream.alias("n")).select(line.alias("value"))
    return [head, body, state_line(ev, "events", "event_id")]


LOOSE_SCHEMA = {
    "type": "object",
    "properties": {
        "o_orderkey": {"type": "integer"},
        "o_custkey": {"type": ["null", "integer"]},
        "o_orderstatus": {"type": ["null", "string"]},
        "o_totalprice": {"type": ["null", "number"]},
        "o_orderdate": {"type": ["null", "string"], "format": "date-time"},
        "o_orderpriority": {"type": "string"},
    },
}


def _orders_loose(spark, sf_dir):
    """FIXTURES 4.3: by o_orderkey: %7=0 key as text, %7=1 price as text,
    %11=0 o_orderpriority missing, %13=0 extra key, %17=0 unparsable date."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    rec = F.struct(
        k.alias("o_orderkey"),
        F.col("o_custkey"),
        F.col("o_orderstatus"),
        F.col("o_totalprice"),
        F.when(k % 17 == 0, F.lit("not a date")).otherwise(F.date_format("o_orderdate", TS_FORMAT)).alias("o_orderdate"),
        F.when(k % 11 != 0, F.col("o_orderpriority")).alias("o_orderpriority"),
        F.when(k % 13 == 0, F.lit("extra")).alias("o_comment"),
    )
    j = F.to_json(F.struct(F.lit("RECORD").alias("type"), F.lit("orders").alias("stream"), rec.alias("record")),
                  JSON_OPTS)
    body = o.select(k, j.alias("value")).select(
        F.when(k % 7 == 0, F.regexp_replace("value", r'"o_orderkey":(-?\d+)', '"o_orderkey":"$1"'))
        .when(k % 7 == 1, F.regexp_replace("value", r'"o_totalprice":([^,}]+)', '"o_totalprice":"$1"'))
        .otherwise(F.col("value"))
        .alias("value")
    )
    head = _lines(spark, [schema_line("orders", LOOSE_SCHEMA, ["o_orderkey"])])
    return [head, body, state_line(o, "orders", "o_orderkey")]


def _orders_lossy(spark, sf_dir):
    """orders whose SCHEMA declares o_totalprice an integer while values have cents."""
    o = table(spark, sf_dir, "orders")
    schema = spark_to_json_schema(o.schema)
    schema["properties"]["o_totalprice"] = {"type": ["null", "integer"]}
    head = _lines(spark, [schema_line("orders", schema, ["o_orderkey"])])
    return [head, record_lines(o, "orders")]


# fixed value: the date that splits the two-schema feed (FIXTURES 4.4)
SCHEMA_SPLIT_DATE = "1998-01-01"


def _orders_two_schemas(spark, sf_dir):
    """FIXTURES 4.4: SCHEMA v1, older rows, SCHEMA v2 (+o_orderpriority), newer rows."""
    o = table(spark, sf_dir, "orders")
    v2 = o.schema
    v1 = type(v2)([f for f in v2.fields if f.name != "o_orderpriority"])
    old = o.where(F.col("o_orderdate") < F.lit(SCHEMA_SPLIT_DATE).cast("timestamp_ntz"))
    new = o.where(F.col("o_orderdate") >= F.lit(SCHEMA_SPLIT_DATE).cast("timestamp_ntz"))
    return [
        _lines(spark, [schema_line("orders", spark_to_json_schema(v1), ["o_orderkey"])]),
        record_lines(old.drop("o_orderpriority"), "orders"),
        _lines(spark, [schema_line("orders", spark_to_json_schema(v2), ["o_orderkey"])]),
        record_lines(new, "orders"),
    ]


def _events_no_schema(spark, sf_dir):
    """FIXTURES 4.5: RECORDs only; rows in the upper half of event_id carry an extra key."""
    ev = table(spark, sf_dir, "events")
    top = ev.agg(F.max("event_id")).first()[0]  # one aggregate value
    upper = F.col("event_id") * 2 > F.lit(top)
    rec = F.struct(*[F.col(c) for c in ev.columns], F.when(upper, F.concat(F.lit("x"), F.col("event_id"))).alias("extra"))
    return [record_lines(ev, "events", rec)]


# fixed value: name of the stream announced with a SCHEMA and no rows (FIXTURES 4.6)
EMPTY_STREAM = "customer_archive"


def _multi_stream(spark, sf_dir):
    """FIXTURES 4.6: nation + region + supplier interleaved, one stream with no rows."""
    n, r, s = (table(spark, sf_dir, t) for t in ("nation", "region", "supplier"))
    c = table(spark, sf_dir, "customer")
    heads = _lines(
        spark,
        [
            schema_line("nation", spark_to_json_schema(n.schema), ["n_nationkey"]),
            schema_line("region", spark_to_json_schema(r.schema), ["r_regionkey"]),
            schema_line("supplier", spark_to_json_schema(s.schema), ["s_suppkey"]),
            schema_line(EMPTY_STREAM, spark_to_json_schema(c.schema), ["c_custkey"]),
        ],
    )
    body = record_lines(n, "nation").unionByName(record_lines(r, "region")).unionByName(record_lines(s, "supplier"))
    return [heads, body, state_line(s, "supplier", "s_suppkey")]


def _growing(whole: bool):
    """events (bookmarked by its STATE) and supplier (without one): the lower half of the keys, or all."""

    def build(spark, sf_dir):
        ev, su = table(spark, sf_dir, "events"), table(spark, sf_dir, "supplier")
        heads = _lines(spark, [schema_line("events", spark_to_json_schema(ev.schema), ["event_id"]),
                               schema_line("supplier", spark_to_json_schema(su.schema), ["s_suppkey"])])
        if not whole:
            ev, su = (t.where(F.col(k) * 2 <= t.agg(F.max(k)).first()[0]) for t, k in ((ev, "event_id"), (su, "s_suppkey")))
        body = record_lines(ev, "events").unionByName(record_lines(su, "supplier"))
        return [heads, body, state_line(ev, "events", "event_id")]

    return build


VARIANTS = {
    "growing_half": (_growing(False), ["events", "supplier"]),
    "growing_all": (_growing(True), ["events", "supplier"]),
    "lineitem": (_clean("lineitem", "l_orderkey", ["l_orderkey", "l_linenumber"]), ["lineitem"]),
    "orders": (_clean("orders", "o_orderkey", ["o_orderkey"]), ["orders"]),
    "embeddings": (_clean("embeddings", "vec_id", ["vec_id"]), ["embeddings"]),
    "events": (_events_objects, ["events"]),
    "events_dirty": (_events_dirty, ["events"]),
    "orders_loose": (_orders_loose, ["orders"]),
    "orders_lossy": (_orders_lossy, ["orders"]),
    "orders_two_schemas": (_orders_two_schemas, ["orders"]),
    "events_no_schema": (_events_no_schema, ["events"]),
    "multi_stream": (_multi_stream, ["nation", "region", "supplier", "customer"]),
}
