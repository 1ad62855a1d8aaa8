"""Queries over message feeds: envelope, rejects, routing, decode."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedlake.functions import month_text
from feedlake.operators import envelope as E
from feedlake.operators.clean import dealt_for_sort, dedupe_keep_first
from feedlake.operators.decode import json_schema_fields, required_violations
from feedlake.operators.ingest import decode_all, decode_feed
from feedlake.plans.feeds import EMPTY_STREAM, SCHEMA_SPLIT_DATE, fixture
from feedlake.plans.registry import query
from feedlake.session import scratch_path
from feedlake.sources.feed import feed_lines, read_feed

LINEITEM_COLS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]
# total order for keep-first on (l_orderkey, l_linenumber): every other column breaks ties
LINEITEM_FIRST = [c for c in LINEITEM_COLS if c not in ("l_orderkey", "l_linenumber")]


def feed(spark, sf_dir, variant):
    return read_feed(spark, fixture(spark, sf_dir, variant))


@query(
    "feed_envelope",
    """
SELECT 'SCHEMA' AS type, 'events' AS stream, CAST(NULL AS BIGINT) AS rec_key
UNION ALL SELECT 'RECORD', 'events', event_id FROM events
UNION ALL SELECT 'STATE', NULL, NULL FROM (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events)
""",
)
def feed_envelope(spark, sf_dir):
    env = feed(spark, sf_dir, "events")
    return E.accepted(env).select(
        "type", "stream", F.get_json_object("record", "$.event_id").cast("bigint").alias("rec_key")
    )


@query(
    "feed_type_counts",
    f"""
SELECT 'SCHEMA' AS type, s AS stream, CAST(1 AS BIGINT) AS n_messages
FROM (VALUES ('nation'), ('region'), ('supplier'), ('{EMPTY_STREAM}')) t(s)
UNION ALL SELECT 'RECORD', 'nation', count(*) FROM nation
UNION ALL SELECT 'RECORD', 'region', count(*) FROM region
UNION ALL SELECT 'RECORD', 'supplier', count(*) FROM supplier
UNION ALL SELECT 'STATE', NULL, CAST(1 AS BIGINT)
""",
)
def feed_type_counts(spark, sf_dir):
    return E.type_counts(feed(spark, sf_dir, "multi_stream"))


@query(
    "feed_rejects",
    """
SELECT CASE event_id % 10 WHEN 0 THEN 'malformed' WHEN 1 THEN 'not_object' ELSE 'missing_key' END
         AS reject_reason,
       count(*) AS n_lines
FROM events WHERE event_id % 10 IN (0, 1, 3) GROUP BY 1
""",
)
def feed_rejects(spark, sf_dir):
    rej = E.rejects(feed(spark, sf_dir, "events_dirty"))
    return rej.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n_lines"))


_ROUTE_KEYS = {"nation": "n_nationkey", "region": "r_regionkey", "supplier": "s_suppkey", EMPTY_STREAM: "c_custkey"}


@query(
    "feed_route_streams",
    f"""
SELECT 'nation' AS stream, count(*) AS n_rows, CAST(3 AS BIGINT) AS n_columns,
       CAST(sum(n_nationkey) AS BIGINT) AS key_sum FROM nation
UNION ALL SELECT 'region', count(*), 2, CAST(sum(r_regionkey) AS BIGINT) FROM region
UNION ALL SELECT 'supplier', count(*), 4, CAST(sum(s_suppkey) AS BIGINT) FROM supplier
UNION ALL SELECT '{EMPTY_STREAM}', 0, 5, NULL
""",
)
def feed_route_streams(spark, sf_dir):
    out = None
    staged = decode_all(feed(spark, sf_dir, "multi_stream"), stage=scratch_path(spark, "route"))
    for stream, dec in staged.items():
        stats = dec.rows.agg(
            F.lit(stream).alias("stream"),
            F.count(F.lit(1)).alias("n_rows"),
            F.lit(len(dec.fields)).cast("bigint").alias("n_columns"),
            F.sum(_ROUTE_KEYS[stream]).cast("bigint").alias("key_sum"),
        )
        out = stats if out is None else out.unionByName(stats)
    return out


@query(
    "feed_stream_filter",
    """
SELECT 'nation' AS stream, CAST(n_nationkey AS BIGINT) AS rec_key FROM nation
UNION ALL SELECT 'supplier', s_suppkey FROM supplier
""",
)
def feed_stream_filter(spark, sf_dir):
    env = E.stream_filter(feed(spark, sf_dir, "multi_stream"), ["nation", "supplier"])
    key = F.coalesce(F.get_json_object("record", "$.n_nationkey"), F.get_json_object("record", "$.s_suppkey"))
    return E.records(env).select("stream", key.cast("bigint").alias("rec_key"))


@query(
    "feed_decode_typed",
    """
SELECT l_orderkey, l_partkey, l_suppkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_quantity,
       l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate
FROM lineitem
""",
)
def feed_decode_typed(spark, sf_dir):
    return decode_feed(spark, fixture(spark, sf_dir, "lineitem"), "lineitem").rows


@query(
    "feed_month_revenue",
    f"""
WITH d AS (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                               ORDER BY {", ".join(LINEITEM_FIRST)}) AS rn
  FROM lineitem)
SELECT strftime(l_shipdate, '%Y-%m') AS month,
       round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue,
       count(*) AS n_lines
FROM d WHERE rn = 1 GROUP BY 1
""",
)
def feed_month_revenue(spark, sf_dir):
    """Flagship: lineitem feed -> decode -> keep-first dedupe -> revenue per month."""
    path, keys = fixture(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"]
    rows = decode_feed(spark, path, "lineitem").rows
    lines = feed_lines(spark, path).count()  # text only, nothing is parsed
    first = dedupe_keep_first(dealt_for_sort(rows, keys, lines), keys, LINEITEM_FIRST)
    return first.groupBy(month_text("l_shipdate").alias("month")).agg(
        F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"),
        F.count(F.lit(1)).alias("n_lines"),
    )


_LOOSE_SQL = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
       CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_orderdate END AS o_orderdate,
       CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority
FROM orders
"""


@query("decode_text_numbers", _LOOSE_SQL)
def decode_text_numbers(spark, sf_dir):
    """Keys and prices sent as text decode to numbers; a bad date becomes null."""
    path = fixture(spark, sf_dir, "orders_loose")
    return decode_feed(spark, path, "orders", on_mismatch="null", on_required="null").rows


@query(
    "decode_lossy_int",
    "SELECT o_orderkey, CAST(trunc(o_totalprice) AS BIGINT) AS o_totalprice FROM orders",
)
def decode_lossy_int(spark, sf_dir):
    rows = decode_feed(spark, fixture(spark, sf_dir, "orders_lossy"), "orders", lossy_int="truncate").rows
    return rows.select("o_orderkey", "o_totalprice")


@query("decode_object_text", "SELECT event_id, replace(props, ' ', '') AS props FROM events")
def decode_object_text(spark, sf_dir):
    return decode_feed(spark, fixture(spark, sf_dir, "events"), "events").rows.select("event_id", "props")


@query(
    "decode_array",
    """
SELECT vec_id, label, CAST(pos AS INTEGER) AS pos, CAST(value AS FLOAT) AS value
FROM (SELECT vec_id, CAST(label AS BIGINT) AS label,
             generate_subscripts(embedding, 1) - 1 AS pos, unnest(embedding) AS value
      FROM embeddings)
""",
)
def decode_array(spark, sf_dir):
    rows = decode_feed(spark, fixture(spark, sf_dir, "embeddings"), "embeddings").rows
    return rows.select("vec_id", "label", F.posexplode("embedding").alias("pos", "v")).select(
        "vec_id", "label", "pos", F.col("v").cast("float").alias("value")
    )


@query(
    "required_violations",
    """
SELECT 'o_orderkey' AS column_name, CAST(0 AS BIGINT) AS violations
UNION ALL SELECT 'o_orderpriority', count(*) FROM orders WHERE o_orderkey % 11 = 0
""",
)
def required_violations_q(spark, sf_dir):
    env = feed(spark, sf_dir, "orders_loose")
    fields = json_schema_fields(E.schema_map(env)["orders"]["schema"])
    return required_violations(E.records(env, "orders"), fields).withColumnRenamed("column", "column_name")


@query(
    "infer_no_schema",
    """
SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS ts, user_id, event_type, value, props,
       CASE WHEN event_id * 2 > (SELECT max(event_id) FROM events) THEN 'x' || event_id END AS extra
FROM events
""",
)
def infer_no_schema(spark, sf_dir):
    return decode_feed(spark, fixture(spark, sf_dir, "events_no_schema"), "events").rows


@query(
    "latest_schema",
    f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
       CASE WHEN o_orderdate >= TIMESTAMP '{SCHEMA_SPLIT_DATE}' THEN o_orderpriority END AS o_orderpriority
FROM orders
""",
)
def latest_schema(spark, sf_dir):
    """All rows land under the last SCHEMA; rows sent before it lack the new column."""
    return decode_feed(spark, fixture(spark, sf_dir, "orders_two_schemas"), "orders").rows


@query(
    "latest_state",
    "SELECT count(DISTINCT CAST(ts AS DATE)) AS n_states, max(ts) AS bookmark_ts FROM events",
)
def latest_state(spark, sf_dir):
    st = E.latest_state(feed(spark, sf_dir, "events"))
    return st.select(
        "n_states",
        F.get_json_object("value", "$.bookmarks.events.ts").cast("timestamp_ntz").alias("bookmark_ts"),
    )

