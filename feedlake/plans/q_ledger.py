"""Run ledger, catalog and bookmark queries.

No run log ships with the driver data, so a ledger is derived from
``events``: one run per event, pipeline ``pipe_<user_id>`` (one source per
pipeline), stream ``stream_<k % 3>`` from the JSON props, started at ``ts``,
lasting ``value`` seconds, failed when ``event_type = 'error'``, landing
``floor(value)`` records when it succeeded.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from feedlake.operators import bookmarks as B
from feedlake.operators import envelope as E
from feedlake.operators import ledger as L
from feedlake.operators.ingest import decode_all, decode_feed
from feedlake.plans.feeds import fixture, table
from feedlake.plans.registry import query
from feedlake.session import scratch_path
from feedlake.sources.feed import read_feed

LEDGER_SQL = """
WITH ledger AS (
  SELECT event_id AS run_id,
         'pipe_' || CAST(user_id AS VARCHAR) AS pipeline,
         'pipe_' || CAST(user_id AS VARCHAR) AS source,
         'stream_' || CAST(CAST(json_extract(props, '$.k') AS BIGINT) % 3 AS VARCHAR) AS stream,
         ts AS started_at,
         value AS duration_seconds,
         CASE WHEN event_type = 'error' THEN 'failure' ELSE 'success' END AS status,
         CASE WHEN event_type = 'error' THEN 0 ELSE CAST(floor(value) AS BIGINT) END AS records,
         CASE WHEN event_type = 'error' THEN 'tap crashed' END AS error
  FROM events),
latest AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY pipeline ORDER BY started_at DESC, run_id DESC) AS rn
    FROM ledger) WHERE rn = 1),
rollup AS (
  SELECT source, stream, CAST(sum(records) AS BIGINT) AS total_rows, count(*) AS extractions,
         max(started_at) AS last_extraction,
         max(records) FILTER (WHERE rk = 1) AS last_extraction_rows
  FROM (SELECT *, row_number() OVER (PARTITION BY source, stream ORDER BY started_at DESC, run_id DESC) AS rk
        FROM ledger WHERE status = 'success')
  GROUP BY 1, 2)
"""

MIDPOINT_SQL = "(SELECT make_timestamp((epoch_us(min(ts)) + epoch_us(max(ts))) // 2) FROM events)"


def derived_ledger(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    fail = F.col("event_type") == "error"
    pipe = F.concat(F.lit("pipe_"), F.col("user_id").cast("string"))
    k = F.get_json_object("props", "$.k").cast("bigint")
    return ev.select(
        F.col("event_id").alias("run_id"),
        pipe.alias("pipeline"),
        pipe.alias("source"),
        F.concat(F.lit("stream_"), (k % 3).cast("string")).alias("stream"),
        F.col("ts").alias("started_at"),
        F.col("value").alias("duration_seconds"),
        F.when(fail, "failure").otherwise("success").alias("status"),
        F.when(fail, F.lit(0).cast("bigint")).otherwise(F.floor("value").cast("bigint")).alias("records"),
        F.when(fail, F.lit("tap crashed")).alias("error"),
    )


def midpoint(df, col):
    """Middle instant of ``col`` (one aggregate row to the driver), exact in microseconds."""
    r = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi")).first()
    epoch = dt.datetime(1970, 1, 1)
    us = ((r["lo"] - epoch) // dt.timedelta(microseconds=1) + (r["hi"] - epoch) // dt.timedelta(microseconds=1)) // 2
    return epoch + dt.timedelta(microseconds=us)


def ntz(value: dt.datetime):
    """A wall-clock literal; built from text so no time zone (Python's or the session's) shifts it."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


@query("run_log_rows", LEDGER_SQL + "SELECT * FROM ledger")
def run_log_rows(spark, sf_dir):
    """Runs appended to the ledger table in two batches, read back whole."""
    runs = derived_ledger(spark, sf_dir)
    cut = ntz(midpoint(runs, "started_at"))
    path = scratch_path(spark, "ledger")
    L.append_runs(runs.where(F.col("started_at") < cut), path)
    L.append_runs(runs.where(F.col("started_at") >= cut), path)
    return L.read_ledger(spark, path)


@query("manifest_rollup", LEDGER_SQL + "SELECT * FROM rollup")
def manifest_rollup(spark, sf_dir):
    return L.manifest_rollup(derived_ledger(spark, sf_dir))


@query("manifest_merge", LEDGER_SQL + "SELECT * FROM rollup")
def manifest_merge(spark, sf_dir):
    """Catalog of the first half of the runs, upserted with the second half."""
    runs = derived_ledger(spark, sf_dir)
    cut = ntz(midpoint(runs, "started_at"))
    old = L.manifest_rollup(runs.where(F.col("started_at") < cut))
    new = L.manifest_rollup(runs.where(F.col("started_at") >= cut))
    return L.manifest_merge(old, new)


@query(
    "manifest_flat",
    LEDGER_SQL + "SELECT 'raw/' || source || '/' || stream AS location, total_rows AS row_count FROM rollup",
)
def manifest_flat(spark, sf_dir):
    return L.manifest_flat(L.manifest_rollup(derived_ledger(spark, sf_dir)))


@query(
    "manifest_columns",
    """
SELECT 'o_orderkey' AS column_name, 'bigint' AS data_type, count(*) FILTER (WHERE o_orderkey IS NULL) AS null_count
FROM orders
UNION ALL SELECT 'o_custkey', 'bigint', count(*) FILTER (WHERE o_custkey IS NULL) FROM orders
UNION ALL SELECT 'o_orderstatus', 'string', count(*) FILTER (WHERE o_orderstatus IS NULL) FROM orders
UNION ALL SELECT 'o_totalprice', 'double', count(*) FILTER (WHERE o_totalprice IS NULL) FROM orders
UNION ALL SELECT 'o_orderdate', 'timestamp_ntz', count(*) FILTER (WHERE o_orderkey % 17 = 0 OR o_orderdate IS NULL)
FROM orders
UNION ALL SELECT 'o_orderpriority', 'string', count(*) FILTER (WHERE o_orderkey % 11 = 0 OR o_orderpriority IS NULL)
FROM orders
""",
)
def manifest_columns(spark, sf_dir):
    """Column profile of the table landed from the loose orders feed."""
    rows = decode_feed(spark, fixture(spark, sf_dir, "orders_loose"), "orders", on_mismatch="null",
                       on_required="null").rows
    return L.column_profile(rows)


@query(
    "run_totals",
    LEDGER_SQL
    + """
SELECT pipeline, day, CAST(sum(n) AS BIGINT) AS total_records, round(sum(d), 3) AS duration_seconds,
       string_agg(stream || '=' || CAST(n AS VARCHAR), ';' ORDER BY stream || '=' || CAST(n AS VARCHAR)) AS streams
FROM (SELECT pipeline, CAST(started_at AS DATE) AS day, stream, sum(records) AS n, sum(duration_seconds) AS d
      FROM ledger GROUP BY 1, 2, 3)
GROUP BY 1, 2
""",
)
def run_totals(spark, sf_dir):
    return L.run_totals(derived_ledger(spark, sf_dir))


@query(
    "run_summary",
    LEDGER_SQL
    + """
SELECT CAST(started_at AS DATE) AS day, count(*) FILTER (WHERE status = 'success') AS succeeded,
       count(*) FILTER (WHERE status <> 'success') AS failed
FROM ledger GROUP BY 1
""",
)
def run_summary(spark, sf_dir):
    return L.run_summary(derived_ledger(spark, sf_dir))


@query("run_latest", LEDGER_SQL + "SELECT * FROM latest")
def run_latest(spark, sf_dir):
    return L.run_latest(derived_ledger(spark, sf_dir))


@query(
    "run_last_n",
    LEDGER_SQL
    + """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY pipeline ORDER BY started_at DESC, run_id DESC) AS rn FROM ledger)
WHERE rn <= 10
""",
)
def run_last_n(spark, sf_dir):
    return L.run_last_n(derived_ledger(spark, sf_dir), 10)


@query(
    "run_status",
    LEDGER_SQL
    + """
SELECT 'pipe_' || CAST(c.c_custkey AS VARCHAR) AS name, l.started_at AS last_run,
       coalesce(l.status, 'no runs') AS status, l.duration_seconds AS duration, l.records
FROM customer c LEFT JOIN latest l ON l.pipeline = 'pipe_' || CAST(c.c_custkey AS VARCHAR)
""",
)
def run_status(spark, sf_dir):
    """Configured pipelines (one per customer) with their latest run or ``no runs``."""
    pipes = table(spark, sf_dir, "customer").select(F.concat(F.lit("pipe_"), F.col("c_custkey").cast("string")).alias("name"))
    return L.run_status(pipes, derived_ledger(spark, sf_dir))


@query(
    "run_stale",
    LEDGER_SQL
    + """
SELECT pipeline, started_at AS last_run FROM latest
WHERE CAST(started_at AS DATE) < (SELECT CAST(max(ts) AS DATE) FROM events)
""",
)
def run_stale(spark, sf_dir):
    """Latest run older than the newest day in the ledger (the reference date)."""
    runs = derived_ledger(spark, sf_dir)
    as_of = runs.agg(F.max("started_at").alias("m")).first()["m"].date()
    return L.run_stale(runs, F.lit(as_of))


@query(
    "run_failed_latest",
    LEDGER_SQL + "SELECT pipeline, started_at, error FROM latest WHERE status = 'failure'",
)
def run_failed_latest(spark, sf_dir):
    return L.run_failed_latest(derived_ledger(spark, sf_dir))


@query(
    "bookmark_filter",
    f"SELECT event_id, ts FROM events WHERE ts > (SELECT max(ts) FROM events WHERE ts < {MIDPOINT_SQL})",
)
def bookmark_filter(spark, sf_dir):
    """A first run lands events up to the midpoint and saves its bookmark;
    the incremental run reads only newer rows (the bound is pushed to the scan)."""
    ev = table(spark, sf_dir, "events")
    cut = ntz(midpoint(ev, "ts"))
    path = scratch_path(spark, "bookmarks")
    _, first = B.incremental(ev.where(F.col("ts") < cut), "events", "ts", B.load(spark, path))
    B.save(first, path)
    rows, _ = B.incremental(ev, "events", "ts", B.load(spark, path))
    return rows.select("event_id", "ts")


@query(
    "bookmark_full",
    "SELECT count(*) AS n_rows, strftime(max(ts), '%Y-%m-%dT%H:%M:%S.%f') AS bookmark FROM events",
)
def bookmark_full(spark, sf_dir):
    """A forced full run ignores the stored bookmark and replaces it."""
    ev = table(spark, sf_dir, "events")
    cut = ntz(midpoint(ev, "ts"))
    path = scratch_path(spark, "bookmarks")
    _, first = B.incremental(ev.where(F.col("ts") < cut), "events", "ts", B.load(spark, path))
    B.save(first, path)
    rows, new = B.incremental(ev, "events", "ts", B.load(spark, path), full=True)
    B.save(new, path)
    saved = B.value_for(B.load(spark, path), "events")
    return rows.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(saved).alias("bookmark"))


@query(
    "bookmark_advance",
    """
SELECT 'nation' AS stream, 'n_nationkey' AS key_column, CAST(max(n_nationkey) AS VARCHAR) AS value FROM nation
UNION ALL SELECT 'region', 'r_regionkey', CAST(max(r_regionkey) AS VARCHAR) FROM region
UNION ALL SELECT 'supplier', 's_suppkey', CAST(max(s_suppkey) AS VARCHAR) FROM supplier
""",
)
def bookmark_advance(spark, sf_dir):
    """K9: after a multi-stream run, one bookmark per stream that landed rows, keyed by
    the stream's first key property; saved after the data, then read back."""
    env = read_feed(spark, fixture(spark, sf_dir, "multi_stream"))
    schemas = E.schema_map(env)
    out = None
    for stream, dec in decode_all(env).items():
        key = schemas[stream]["key_properties"][0]
        bm = B.bookmark_of(dec.rows, stream, key).where(F.col("value").isNotNull())
        out = bm if out is None else out.unionByName(bm)
    path = scratch_path(spark, "bookmarks")
    B.save(out, path)
    return B.load(spark, path)



STREAMS_SQL = """
WITH ledger AS (
  SELECT event_id AS run_id, 'pipe_' || CAST(user_id AS VARCHAR) AS pipeline, 'pipe_' || CAST(user_id AS VARCHAR) AS source,
         'stream_' || CAST(i AS VARCHAR) AS stream, ts AS started_at, value AS duration_seconds,
         CASE WHEN event_type = 'error' AND i = 0 THEN 'failure' ELSE 'success' END AS status,
         CASE WHEN event_type = 'error' AND i = 0 THEN 0 ELSE CAST(floor(value) AS BIGINT) + i END AS records,
         CASE WHEN event_type = 'error' AND i = 0 THEN 'tap crashed' END AS error,
         CASE WHEN event_id % 5 < 2 THEN 'double' ELSE 'string' END AS v_type,
         (event_id + i) % 3 = 0 AS has_x
  FROM events, range(3) r(i)),
runs AS (
  SELECT run_id, pipeline, any_value(source) AS source, string_agg(stream, ',' ORDER BY stream) AS stream,
         any_value(started_at) AS started_at, max(duration_seconds) AS duration_seconds, min(status) AS status,
         CAST(sum(records) AS BIGINT) AS records, min(error) AS error
  FROM ledger GROUP BY 1, 2)
"""


def streams_ledger(spark, sf_dir):
    """A ledger of runs with three streams each; the first of a failed run failed. Columns change between runs."""
    base = derived_ledger(spark, sf_dir).drop("stream")
    rows = base.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(2))))
    ok = (F.col("status") == "success") | (F.col("i") > 0)
    column = lambda name, kind, null: F.struct(F.lit(name).alias("name"), kind.alias("type"), F.lit(null).alias("nullable"))
    v_type = F.when(F.col("run_id") % 5 < 2, "double").otherwise("string")
    always = F.array(column("id", F.lit("bigint"), False), column("v", v_type, True))
    extra = F.array(column("x", F.lit("date"), True))
    return rows.select(
        "run_id", "pipeline", "source", F.concat(F.lit("stream_"), F.col("i").cast("string")).alias("stream"),
        "started_at", "duration_seconds", F.when(ok, "success").otherwise("failure").alias("status"),
        F.when(ok, F.floor("duration_seconds").cast("bigint") + F.col("i")).otherwise(F.lit(0).cast("bigint")).alias("records"),
        F.when(~ok, F.lit("tap crashed")).alias("error"),
        F.when((F.col("run_id") + F.col("i")) % 3 == 0, F.concat(always, extra)).otherwise(always).alias("columns"),
    )


@query(
    "run_latest_streams",
    STREAMS_SQL
    + """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY pipeline ORDER BY started_at DESC, run_id DESC) AS rn FROM runs)
WHERE rn = 1
""",
)
def run_latest_streams(spark, sf_dir):
    """The latest run of each pipeline where a run has three streams, one of which may have failed."""
    return L.run_latest(streams_ledger(spark, sf_dir).select(*L.LEDGER_COLUMNS))


@query(
    "run_last_n_streams",
    STREAMS_SQL
    + """
SELECT run_id, pipeline, source, stream, started_at, duration_seconds, status, records, error FROM (
  SELECT *, dense_rank() OVER (PARTITION BY pipeline ORDER BY started_at DESC, run_id DESC) AS rn FROM ledger) WHERE rn <= 3
""",
)
def run_last_n_streams(spark, sf_dir):
    """The streams of the last three runs of each pipeline."""
    return L.run_last_n(streams_ledger(spark, sf_dir).select(*L.LEDGER_COLUMNS), 3)


@query(
    "run_totals_by_run",
    STREAMS_SQL
    + """
SELECT r.run_id, r.pipeline, r.started_at, r.status, r.records AS total_records, r.duration_seconds, t.streams
FROM runs r JOIN (
  SELECT run_id, string_agg(stream || '=' || CAST(records AS VARCHAR), ';' ORDER BY stream || '=' || CAST(records AS VARCHAR)) AS streams
  FROM ledger GROUP BY 1) t USING (run_id)
""",
)
def run_totals_by_run(spark, sf_dir):
    """Totals of each run, as a run log holds them."""
    return L.totals_by_run(streams_ledger(spark, sf_dir))


@query(
    "manifest_listing",
    STREAMS_SQL
    + """
, last AS (SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY source, stream ORDER BY started_at DESC, run_id DESC) AS rn
    FROM ledger WHERE status = 'success') WHERE rn = 1)
SELECT source, stream, 0 AS position, 'id' AS name, 'bigint' AS type, false AS nullable FROM last
UNION ALL SELECT source, stream, 1, 'v', v_type, true FROM last
UNION ALL SELECT source, stream, 2, 'x', 'date', true FROM last WHERE has_x
""",
)
def manifest_listing(spark, sf_dir):
    """Name, type and nullability of every table's columns, as its last successful run landed them."""
    return L.manifest_listing(streams_ledger(spark, sf_dir))


@query(
    "schema_drift",
    STREAMS_SQL
    + """
, h AS (SELECT *, lag(v_type) OVER w AS old_v, lag(has_x) OVER w AS old_x FROM ledger WHERE status = 'success'
        WINDOW w AS (PARTITION BY source, stream ORDER BY started_at, run_id))
SELECT run_id, source, stream, 'v' AS name, 'type' AS change, old_v AS old_type, v_type AS new_type FROM h WHERE old_v <> v_type
UNION ALL SELECT run_id, source, stream, 'x', 'added', NULL, 'date' FROM h WHERE has_x AND NOT old_x
UNION ALL SELECT run_id, source, stream, 'x', 'removed', 'date', NULL FROM h WHERE old_x AND NOT has_x
""",
)
def schema_drift(spark, sf_dir):
    """T4: columns that a run added, removed or typed anew, against the run before it."""
    return L.schema_drift(streams_ledger(spark, sf_dir))
