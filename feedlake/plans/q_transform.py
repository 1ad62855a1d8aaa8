"""Transform queries (T1-T3, T5) and per-stream counts around a transform (A1)."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from feedlake import functions as X
from feedlake import pipeline as P
from feedlake.operators import clean as C
from feedlake.operators import land as K
from feedlake.operators import ledger as L
from feedlake.operators import transform as T
from feedlake.plans.feeds import fixture, table
from feedlake.plans.q_land import _FAN_SQL, _stream_transform
from feedlake.plans.registry import query
from feedlake.session import scratch_path
from feedlake.sources.feed import read_feed


def clean_orders(df):
    """The documented cleaning script, on orders: drop one status (nulls kept), tidy a
    text field, keep the first row per key, derive month and amount, drop a personal id."""
    df = C.filter_ne(df, "o_orderstatus", "P")
    df = df.withColumn("o_orderpriority", X.clean_text("o_orderpriority"))
    df = C.dedupe_keep_first(df, ["o_orderkey"], ["o_orderdate", "o_totalprice", "o_custkey"])
    df = df.withColumn("order_month", X.month_text("o_orderdate"))
    df = df.withColumn("amount", X.numeric_fill("o_totalprice"))
    return df.drop("o_custkey")


_CLEAN_SQL = """
SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderdate, lower(trim(o_orderpriority)) AS o_orderpriority,
       strftime(o_orderdate, '%Y-%m') AS order_month, coalesce(o_totalprice, 0.0) AS amount
FROM (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY o_orderdate, o_totalprice, o_custkey) AS rn
      FROM orders WHERE o_orderstatus IS DISTINCT FROM 'P')
WHERE rn = 1
"""


@query("transform_dataset", _CLEAN_SQL)
def transform_dataset(spark, sf_dir):
    """The transform over the whole table (its dedupe sees every row, D1)."""
    return T.apply_dataset(table(spark, sf_dir, "orders"), clean_orders)


def clean_orders_batch(pdf: pd.DataFrame) -> pd.DataFrame:
    """The same cleaning written for pandas, row-local so batch edges do not matter."""
    out = pdf[pdf["o_orderstatus"] != "P"].copy()
    out["o_orderpriority"] = out["o_orderpriority"].str.lower().str.strip()
    out["order_month"] = out["o_orderdate"].dt.strftime("%Y-%m")
    out["amount"] = pd.to_numeric(out["o_totalprice"], errors="coerce").fillna(0.0)
    return out.drop(columns=["o_custkey"])


@query("transform_batched", _CLEAN_SQL)
def transform_batched(spark, sf_dir):
    """A pandas transform per Arrow batch (mapInPandas)."""
    o = table(spark, sf_dir, "orders")
    schema = (
        "o_orderkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
        "o_orderpriority string, order_month string, amount double"
    )
    return T.apply_batched(o, clean_orders_batch, schema, failsafe=False)


def _breaks_on_error_rows(df):
    """A user transform that fails at run time on some rows."""
    bad = F.col("event_type") == "error"
    return df.withColumn("value", F.when(bad, F.raise_error(F.lit("cannot price an error event"))).otherwise(F.col("value")))


@query("transform_failsafe", "SELECT * FROM events")
def transform_failsafe(spark, sf_dir):
    """The transform fails inside the write job, so the raw rows are landed instead."""
    ev = table(spark, sf_dir, "events")
    path = scratch_path(spark, "failsafe")
    T.land_failsafe(ev, _breaks_on_error_rows, path)
    return spark.read.parquet(path)


@query(
    "chain_raw_to_report",
    f"""
WITH c AS ({_CLEAN_SQL})
SELECT order_month, o_orderstatus, count(*) AS orders, round(sum(amount), 2) AS revenue
FROM c GROUP BY 1, 2
""",
)
def chain_raw_to_report(spark, sf_dir):
    """T5: raw -> curated -> report, each stage landed and read back by the next."""
    root = scratch_path(spark, "stages")
    K.land_full(table(spark, sf_dir, "orders"), f"{root}/raw/orders")
    curated = T.apply_dataset(K.read_tree(spark, f"{root}/raw/orders"), clean_orders)
    K.land_full(curated, f"{root}/curated/orders")
    cur = K.read_tree(spark, f"{root}/curated/orders")
    return cur.groupBy("order_month", "o_orderstatus").agg(
        F.count(F.lit(1)).alias("orders"), F.round(F.sum("amount"), 2).alias("revenue")
    )


@query("stream_counts", _FAN_SQL)
def stream_counts(spark, sf_dir):
    """A1: rows per stream before and after the transform, observed in the write job."""
    env = read_feed(spark, fixture(spark, sf_dir, "multi_stream"))
    res = K.fan_out(spark, env, scratch_path(spark, "lake"), "multi", transform=_stream_transform)
    rows = [(s, int(r["rows_raw"]), int(r["rows_out"])) for s, r in sorted(res.streams.items())]
    return spark.createDataFrame(rows, "stream string, rows_raw bigint, rows_out bigint")



@query(
    "pipeline_run",
    "SELECT event_id, ts, user_id, event_type, value, replace(props, ' ', '') AS props FROM events",
)
def pipeline_run(spark, sf_dir):
    """A whole ingest run (feed -> lake -> ledger -> state) over the events feed; the
    landed table is read back. The run's ledger row must say success."""
    lake = scratch_path(spark, "run")
    res = P.run(spark, fixture(spark, sf_dir, "events"), lake, "app", "events_pipe", incremental=True)
    if not res.success:
        raise RuntimeError(res.error)
    ledger = L.read_ledger(spark, f"{lake}/_ledger")
    if ledger.where(F.col("status") != "success").count():
        raise RuntimeError("run ledger records a failure")
    return K.read_table(spark, f"{lake}/app/events").drop("dt")
