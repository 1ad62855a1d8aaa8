"""Bench: time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value" (total seconds), "unit", "queries"
(seconds per query), "rows" (rows out per query), "sf", ...}. Each query is
built and run to completion with the ``noop`` sink (every row computed,
nothing collected) ``BENCH_RUNS`` times (default 2); the faster run counts.
Feed fixtures derived from the tables are built before timing (input
preparation, reported as ``setup_sec``). ``BENCH_QUERIES`` (comma
list) or ``BENCH_ALL=1`` widen the set.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "feed_decode_typed",
    "feed_month_revenue",
    "pipeline_run",
    "dedupe_keep_first",
    "feed_rejects",
    "decode_text_numbers",
    "infer_no_schema",
    "land_fan_out",
    "land_partitioned",
    "parquet_tree_scan",
    "agg_daily_events",
    "agg_monthly_revenue",
    "manifest_rollup",
    "run_status",
    "run_last_n",
    "bookmark_filter",
    "csv_majority_cast",
    "transform_dataset",
    "transform_batched",
    "chain_raw_to_report",
    "clean_text",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from pyspark.sql import Observation
    from pyspark.sql import functions as F

    from feedlake.plans import feeds
    from feedlake.plans.registry import PREPARE, QUERIES, load_all
    from feedlake.session import local_session

    load_all()
    spark = local_session(cpus, shuffle_partitions=max(8, 2 * int(cpus) if cpus.isdigit() else 16))
    if os.environ.get("BENCH_ALL"):
        keys = sorted(QUERIES)
    elif os.environ.get("BENCH_QUERIES"):
        keys = [k.strip() for k in os.environ["BENCH_QUERIES"].split(",") if k.strip()]
    else:
        keys = HEADLINE

    t0 = time.time()
    for variant in feeds.VARIANTS:
        feeds.fixture(spark, sf_dir, variant)
    for prep in PREPARE:
        prep(spark, sf_dir)
    setup = time.time() - t0
    # warm the JVM (class loading, JIT, codegen caches) on the smallest tables, untimed
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir):
        for k in keys[:3]:
            try:
                QUERIES[k](spark, warm_dir).write.format("noop").mode("overwrite").save()
            except Exception:  # noqa: BLE001 - warm-up only
                pass

    runs = int(os.environ.get("BENCH_RUNS", "2"))
    times, rows, errors = {}, {}, {}
    for k in keys:
        for i in range(runs):
            t = time.time()
            try:
                df = QUERIES[k](spark, sf_dir)
                obs = Observation(f"{k}_{i}")
                df.observe(obs, F.count(F.lit(1)).alias("n")).write.format("noop").mode("overwrite").save()
                dt = round(time.time() - t, 3)
                times[k] = min(times.get(k, dt), dt)
                rows[k] = obs.get["n"]
            except Exception as e:  # noqa: BLE001 - report and continue
                errors[k] = f"{type(e).__name__}: {str(e)[:200]}"
                break
    li_rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "headline_total_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "rows": rows,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "setup_sec": round(setup, 3),
        "stat": f"min of {runs} runs per query (plan + execute, noop sink)",
        "decode_rows_per_sec": round(li_rows / times["feed_decode_typed"]) if "feed_decode_typed" in times else None,
    }
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
