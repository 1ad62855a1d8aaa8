"""Landing and lake-read queries.

Each query writes under a fresh folder of the session's scratch root
(``spark.checkpoint.dir``) and returns a read of what was landed.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from feedlake import pipeline as P
from feedlake.operators import curate as R
from feedlake.operators import land as K
from feedlake.operators.publish import RUN_COLUMN
from feedlake.plans.feeds import EMPTY_STREAM, fixture, table
from feedlake.plans.q_ledger import MIDPOINT_SQL, midpoint, ntz
from feedlake.plans.registry import query
from feedlake.session import scratch_path
from feedlake.sources import fs
from feedlake.sources.feed import read_feed


@query(
    "land_codecs",
    """
SELECT c AS codec, count(*) AS n_rows, round(sum(l_quantity), 2) AS sum_qty
FROM lineitem, (VALUES ('zstd'), ('snappy'), ('gzip'), ('none')) t(c) GROUP BY c
""",
)
def land_codecs(spark, sf_dir):
    """K1: the same table landed with each codec reads back whole."""
    li = table(spark, sf_dir, "lineitem")
    root = scratch_path(spark, "codecs")
    out = None
    for codec in K.CODECS:
        K.land_full(li, f"{root}/{codec}", codec)
        back = spark.read.parquet(f"{root}/{codec}").agg(
            F.lit(codec).alias("codec"), F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("l_quantity"), 2).alias("sum_qty")
        )
        out = back if out is None else out.unionByName(back)
    return out


@query("land_full", "SELECT * FROM events WHERE event_type <> 'view'")
def land_full(spark, sf_dir):
    """K2: a second, smaller full run replaces the first completely (no stale files)."""
    ev = table(spark, sf_dir, "events")
    path = scratch_path(spark, "full")
    K.land_full(ev, path, max_records=1000)
    K.land_full(ev.where(F.col("event_type") != "view"), path)
    return spark.read.parquet(path)


@query("land_keeps_old", "SELECT * FROM orders")
def land_keeps_old(spark, sf_dir):
    """A replacement whose write fails leaves every old row in place."""
    o = table(spark, sf_dir, "orders")
    path = scratch_path(spark, "keeps")
    K.land_full(o, path)
    late = F.when(F.col("o_orderkey") >= 0, F.raise_error(F.lit("the write fails"))).cast("bigint")
    try:
        K.land_full(o.withColumn("o_custkey", late), path)
    except Exception as e:  # noqa: BLE001 - the failure is the point
        if "the write fails" not in str(e):
            raise
    return spark.read.parquet(path)


@query(
    "land_retry",
    "SELECT event_type, count(*) * CASE WHEN event_type = 'error' THEN 2 ELSE 1 END AS n_rows FROM events GROUP BY 1",
)
def land_retry(spark, sf_dir):
    """K3: a run that died half-way is tried again the next day and has each row once; a new run appends."""
    ev = table(spark, sf_dir, "events")
    path = scratch_path(spark, "retry")
    K.land_incremental(ev.where("event_type = 'view'"), path, "2024-01-01", run="first")
    K.land_incremental(ev, path, "2024-01-02", run="first")
    K.land_incremental(ev.where("event_type = 'error'"), path, "2024-01-02", run="second")
    return K.read_table(spark, path).groupBy("event_type").agg(F.count(F.lit(1)).alias("n_rows"))


_KEYS = {"events": "event_id", "supplier": "s_suppkey"}
_STATE_SQL = " UNION ALL ".join(
    f"SELECT {run} AS run, '{t}' AS stream, count(*) AS n_rows, min({k}) AS lo, max({k}) AS hi "
    f"FROM {t} WHERE {cond.format(k=k, t=t)}"
    for t, k in _KEYS.items()
    for run, cond in ((1, "{k} * 2 <= (SELECT max({k}) FROM {t})"), (2, "{k} * 2 > (SELECT max({k}) FROM {t})"), (3, "true"))
)


@query("feed_state_runs", _STATE_SQL)
def feed_state_runs(spark, sf_dir):
    """J3/I1/I2 on a feed: the second run gets every record again and lands only those above the saved
    bookmarks (one of the STATE, one of the landed rows); a forced full run lands all."""
    lake = scratch_path(spark, "lake")
    how = {"incremental": True, "bookmark_keys": {"supplier": "s_suppkey"}}
    ids = []
    for variant, more in (("growing_half", {}), ("growing_all", {}), ("growing_all", {"full": True})):
        res = P.run(spark, fixture(spark, sf_dir, variant), lake, "src", "growing", **how, **more)
        if not res.success:
            raise RuntimeError(res.error)
        ids.append(res.run_id)
    nth = F.create_map(*(F.lit(x) for n, i in enumerate(ids, 1) for x in (str(i), n)))
    out = None
    for stream, key in _KEYS.items():
        rows = spark.read.parquet(f"{lake}/src/{stream}")
        df = rows.groupBy(F.element_at(nth, F.col(RUN_COLUMN).cast("string")).alias("run"), F.lit(stream).alias("stream")).agg(
            F.count(F.lit(1)).alias("n_rows"), F.min(key).alias("lo"), F.max(key).alias("hi")
        )
        out = df if out is None else out.unionByName(df)
    return out


@query(
    "land_partitioned",
    f"""
SELECT CASE WHEN ts < {MIDPOINT_SQL} THEN CAST({MIDPOINT_SQL} AS DATE)
            ELSE (SELECT CAST(max(ts) AS DATE) FROM events) END AS dt,
       count(*) AS n_rows
FROM events GROUP BY 1
""",
)
def land_partitioned(spark, sf_dir):
    """K3: two incremental runs, each appending into the ``dt`` partition of its run date."""
    ev = table(spark, sf_dir, "events")
    mid = midpoint(ev, "ts")
    last = ev.agg(F.max("ts")).first()[0]
    path = scratch_path(spark, "incremental")
    cut = ntz(mid)
    K.land_incremental(ev.where(F.col("ts") < cut), path, mid.date().isoformat())
    K.land_incremental(ev.where(F.col("ts") >= cut), path, last.date().isoformat())
    return spark.read.parquet(path).groupBy("dt").agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "land_partition_by",
    "SELECT o_orderpriority, count(*) AS n_rows, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1",
)
def land_partition_by(spark, sf_dir):
    """K4: ``partition_by`` a user column; reading one partition touches only its folder."""
    path = scratch_path(spark, "partition_by")
    K.land_partitioned_by(table(spark, sf_dir, "orders"), path, ["o_orderpriority"])
    back = spark.read.parquet(path)
    return back.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


@query(
    "land_bounded_files",
    "SELECT count(*) AS rows_landed, CAST(0 AS BIGINT) AS files_over_limit, "
    "count(*) > 0 AS enough_files FROM lineitem",
)
def land_bounded_files(spark, sf_dir):
    """K5: files of at most 10,000 rows: every row lands, no file holds more than the bound,
    and there are at least ceil(rows / bound) files."""
    path = scratch_path(spark, "bounded")
    K.land_full(table(spark, sf_dir, "lineitem"), path, max_records=K.BATCH_ROWS)
    per_file = spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("f")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return per_file.agg(
        F.sum("n").alias("rows_landed"),
        F.count_if(F.col("n") > K.BATCH_ROWS).alias("files_over_limit"),
        (F.count(F.lit(1)) * K.BATCH_ROWS >= F.sum("n")).alias("enough_files"),
    )


def _stream_transform(rows, stream):
    """Toy business rule used by the fan-out runs: keep keys >= 3."""
    key = {"nation": "n_nationkey", "region": "r_regionkey", "supplier": "s_suppkey"}.get(stream)
    return rows.where(F.col(key) >= 3) if key else rows


_FAN_SQL = f"""
SELECT 'nation' AS stream, count(*) AS rows_raw, count(*) FILTER (WHERE n_nationkey >= 3) AS rows_out FROM nation
UNION ALL SELECT 'region', count(*), count(*) FILTER (WHERE r_regionkey >= 3) FROM region
UNION ALL SELECT 'supplier', count(*), count(*) FILTER (WHERE s_suppkey >= 3) FROM supplier
UNION ALL SELECT '{EMPTY_STREAM}', 0, 0
"""


@query(
    "land_fan_out",
    f"""
WITH f AS ({_FAN_SQL})
SELECT stream, rows_out AS rows_landed, rows_out AS rows_read_back FROM f
""",
)
def land_fan_out(spark, sf_dir):
    """K6/K7: every stream of one feed landed in one run; a stream with no rows is catalogued
    with zero rows and no files."""
    env = read_feed(spark, fixture(spark, sf_dir, "multi_stream"))
    root = scratch_path(spark, "lake")
    res = K.fan_out(spark, env, root, "multi", transform=_stream_transform)
    out = None
    for stream, r in sorted(res.streams.items()):
        if r["path"] is None:
            df = spark.range(1).select(F.lit(stream).alias("stream"), F.lit(0).cast("bigint").alias("rows_landed"),
                                       F.lit(0).cast("bigint").alias("rows_read_back"))
        else:
            df = spark.read.parquet(r["path"]).agg(
                F.lit(stream).alias("stream"), F.lit(r["rows_out"]).cast("bigint").alias("rows_landed"),
                F.count(F.lit(1)).alias("rows_read_back"),
            )
        out = df if out is None else out.unionByName(df)
    return out


_MONTHLY_SQL = """
SELECT strftime(o_orderdate, '%Y-%m') AS month, round(sum(o_totalprice), 2) AS revenue FROM orders GROUP BY 1
"""


@query("export_csv", _MONTHLY_SQL)
def export_csv(spark, sf_dir):
    """K8: a report exported as CSV with a header, read back with its schema."""
    rep = R.monthly_sum(table(spark, sf_dir, "orders"), "o_orderdate", "o_totalprice", "revenue")
    path = scratch_path(spark, "export_csv")
    K.export(rep, path, "csv")
    return spark.read.option("header", True).schema("month string, revenue double").csv(path)


@query("export_json", _MONTHLY_SQL)
def export_json(spark, sf_dir):
    rep = R.monthly_sum(table(spark, sf_dir, "orders"), "o_orderdate", "o_totalprice", "revenue")
    path = scratch_path(spark, "export_json")
    K.export(rep, path, "json")
    return spark.read.schema("month string, revenue double").json(path)


def _events_tree(spark, sf_dir):
    """events landed as a date-partitioned tree (dt=YYYY-MM-DD/...)."""
    ev = table(spark, sf_dir, "events")
    root = scratch_path(spark, "tree")
    ev.withColumn("dt", F.to_date("ts")).write.partitionBy("dt").parquet(f"{root}/events")
    return root


@query("parquet_tree_scan", "SELECT * FROM events")
def parquet_tree_scan(spark, sf_dir):
    """All Parquet files under a folder at any depth; the ``dt`` folders add no column."""
    return K.read_tree(spark, _events_tree(spark, sf_dir))


@query("parquet_skip_corrupt", "SELECT * FROM events")
def parquet_skip_corrupt(spark, sf_dir):
    """An unreadable ``.parquet`` file in the tree is skipped, the rest is read."""
    root = _events_tree(spark, sf_dir)
    fs.write_bytes(spark, f"{root}/events/dt=1999-01-01/broken.parquet", b"this is not a parquet file")
    return K.read_tree(spark, root, ignore_corrupt=True)


@query(
    "parquet_first_schema",
    """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_custkey END AS o_custkey, o_orderstatus, o_totalprice
FROM orders
""",
)
def parquet_first_schema(spark, sf_dir):
    """S3: the first file's columns rule; later files' extra columns are dropped, missing ones null."""
    o = table(spark, sf_dir, "orders")
    root = scratch_path(spark, "first_schema")
    o.where(F.col("o_orderstatus") == "F").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice") \
        .write.parquet(f"{root}/a")
    o.where(~F.col("o_orderstatus").eqNullSafe("F")).select("o_orderkey", "o_orderstatus", "o_totalprice",
                                                              "o_orderdate").write.parquet(f"{root}/b")
    return K.read_tree(spark, root, schema=K.first_file_schema(spark, root))


@query(
    "union_files",
    """
SELECT event_id, ts, user_id,
       CASE WHEN event_type IN ('click', 'view') THEN event_type END AS event_type,
       CASE WHEN event_type IN ('click', 'view') THEN NULL ELSE value END AS value,
       CASE WHEN event_type IN ('click', 'view') THEN NULL ELSE props END AS props
FROM events
""",
)
def union_files(spark, sf_dir):
    """Two landings of one stream with different columns, unioned by name."""
    ev = table(spark, sf_dir, "events")
    root = scratch_path(spark, "union")
    views = F.col("event_type").isin("click", "view")
    ev.where(views).select("event_id", "ts", "user_id", "event_type").write.parquet(f"{root}/a")
    ev.where(~views).select("event_id", "ts", "user_id", "value", "props").write.parquet(f"{root}/b")
    return K.union_all([spark.read.parquet(f"{root}/a"), spark.read.parquet(f"{root}/b")])
