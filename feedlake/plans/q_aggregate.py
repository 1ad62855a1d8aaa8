"""Report aggregates, keep-first, sort / limit / top-k."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedlake.operators import curate as R
from feedlake.operators.clean import dedupe_keep_first
from feedlake.plans.feeds import table
from feedlake.plans.q_feed import LINEITEM_COLS, LINEITEM_FIRST
from feedlake.plans.registry import query


@query(
    "agg_headcount",
    """
SELECT r.r_name AS region, n.n_name AS city, count(c.c_custkey) AS customer_count,
       min(c.c_acctbal) AS min_balance, max(c.c_acctbal) AS max_balance
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
GROUP BY 1, 2
""",
)
def agg_headcount(spark, sf_dir):
    """A2: customers per (region, city) with min/max; null keys dropped as pandas groupby does."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    geo = n.join(r, n.n_regionkey == r.r_regionkey).select(
        "n_nationkey", F.col("r_name").alias("region"), F.col("n_name").alias("city")
    )
    people = c.join(geo, c.c_nationkey == geo.n_nationkey)
    return R.headcount(people, ["region", "city"], "c_custkey", "c_acctbal")


@query(
    "agg_daily_events",
    """
SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS events, count(DISTINCT user_id) AS users
FROM events GROUP BY 1, 2
""",
)
def agg_daily_events(spark, sf_dir):
    return R.daily_events(table(spark, sf_dir, "events"), "ts", "event_type", "user_id")


@query(
    "agg_monthly_revenue",
    """
SELECT strftime(o_orderdate, '%Y-%m') AS month, round(sum(o_totalprice), 2) AS revenue
FROM orders GROUP BY 1 ORDER BY 1 DESC
""",
)
def agg_monthly_revenue(spark, sf_dir):
    return R.monthly_sum(table(spark, sf_dir, "orders"), "o_orderdate", "o_totalprice", "revenue")


@query(
    "agg_conditional",
    """
SELECT CAST(ts AS DATE) AS day,
       round(sum(CASE WHEN event_type = 'purchase' THEN value ELSE 0 END), 2) AS purchase_value,
       count(*) FILTER (WHERE event_type = 'signup') AS signups,
       count(*) FILTER (WHERE event_type = 'error') AS errors
FROM events GROUP BY 1
""",
)
def agg_conditional(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    t = F.col("event_type")
    return ev.groupBy(F.to_date("ts").alias("day")).agg(
        F.round(F.sum(F.when(t == "purchase", F.col("value")).otherwise(0.0)), 2).alias("purchase_value"),
        F.count_if(t == "signup").alias("signups"),
        F.count_if(t == "error").alias("errors"),
    )


@query(
    "agg_avg_round",
    """
SELECT l_returnflag, round(avg(l_quantity), 2) AS avg_qty, round(avg(l_extendedprice), 2) AS avg_price
FROM lineitem GROUP BY 1
""",
)
def agg_avg_round(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.groupBy("l_returnflag").agg(
        F.round(F.avg("l_quantity"), 2).alias("avg_qty"), F.round(F.avg("l_extendedprice"), 2).alias("avg_price")
    )


@query(
    "agg_distribution",
    "SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1 ORDER BY n DESC, o_orderpriority",
)
def agg_distribution(spark, sf_dir):
    return R.distribution(table(spark, sf_dir, "orders"), "o_orderpriority")


@query("agg_row_count", "SELECT count(*) AS n FROM lineitem")
def agg_row_count(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").agg(F.count(F.lit(1)).alias("n"))


@query(
    "dedupe_keep_first",
    f"""
SELECT {", ".join(LINEITEM_COLS)} FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {", ".join(LINEITEM_FIRST)}) AS rn
  FROM lineitem) WHERE rn = 1
""",
)
def dedupe_keep_first_q(spark, sf_dir):
    """One row per (l_orderkey, l_linenumber); the key repeats in the driver data."""
    li = table(spark, sf_dir, "lineitem")
    return dedupe_keep_first(li, ["l_orderkey", "l_linenumber"], LINEITEM_FIRST)


@query("head_n", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 10")
def head_n(spark, sf_dir):
    """O2: first 10 orders by key (a bare LIMIT is not deterministic)."""
    return table(spark, sf_dir, "orders").orderBy("o_orderkey").limit(10)


@query(
    "top_k",
    "SELECT c_custkey, c_name, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 10",
)
def top_k(spark, sf_dir):
    """O3: top 10 balances, planned as TakeOrderedAndProject (per-task top-k, then merge)."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    return R.top_k(c, 10, [F.col("c_acctbal").desc(), F.col("c_custkey")])
