"""Run ledger, catalog and bookmarks, after the reference's catalog/state tests."""

import datetime as dt

from pyspark.sql import functions as F

from feedlake.operators import bookmarks as B
from feedlake.operators import ledger as L

DDL = ("run_id bigint, pipeline string, source string, stream string, started_at timestamp_ntz, "
       "duration_seconds double, status string, records bigint, error string")


def runs(spark, rows):
    return spark.createDataFrame(rows, DDL)


def t(h):
    return dt.datetime(2024, 1, 1, h)


def test_catalog_accumulates_and_skips_failures(spark):
    led = runs(spark, [
        (1, "p", "pg", "users", t(1), 2.0, "success", 50, None),
        (2, "p", "pg", "orders", t(1), 2.0, "success", 30, None),
        (3, "p", "pg", "users", t(2), 1.0, "success", 30, None),
        (4, "p", "pg", "users", t(3), 1.0, "failure", 0, "tap crashed"),
        (5, "p", "pg", "empty", t(3), 1.0, "success", 0, None),
    ])
    cat = {r["stream"]: r for r in L.manifest_rollup(led).collect()}
    assert cat["users"]["total_rows"] == 80 and cat["users"]["extractions"] == 2
    assert cat["users"]["last_extraction"] == t(2) and cat["users"]["last_extraction_rows"] == 30
    assert cat["orders"]["total_rows"] == 30
    assert cat["empty"]["total_rows"] == 0  # zero-row streams are catalogued (K7)
    flat = {r["location"]: r["row_count"] for r in L.manifest_flat(L.manifest_rollup(led)).collect()}
    assert flat["raw/pg/users"] == 80


def test_merge_equals_rollup_of_all(spark):
    led = runs(spark, [(i, "p", "s", "users", t(i), 1.0, "success", 10 * i, None) for i in range(1, 7)])
    old = L.manifest_rollup(led.where(F.col("run_id") <= 3))
    new = L.manifest_rollup(led.where(F.col("run_id") > 3))
    assert sorted(map(tuple, L.manifest_merge(old, new).collect())) == sorted(map(tuple, L.manifest_rollup(led).collect()))


def test_latest_last_n_status(spark):
    led = runs(spark, [(i, "a", "a", "s", t(i), 1.0, "success" if i < 5 else "failure", i, None if i < 5 else "boom")
                       for i in range(1, 6)])
    latest = L.run_latest(led).first()
    assert latest["run_id"] == 5 and latest["status"] == "failure"
    assert [r["run_id"] for r in L.run_last_n(led, 2).orderBy("started_at").collect()] == [4, 5]
    pipes = spark.createDataFrame([("a",), ("b",)], "name string")
    st = {r["name"]: r["status"] for r in L.run_status(pipes, led).collect()}
    assert st == {"a": "failure", "b": "no runs"}
    assert L.run_failed_latest(led).first()["error"] == "boom"
    assert L.run_stale(led, F.lit(dt.date(2024, 1, 2))).count() == 1
    assert L.run_stale(led, F.lit(dt.date(2024, 1, 1))).count() == 0


def test_ledger_append_round_trip(spark, scratch):
    path = scratch("ledger")
    led = runs(spark, [(1, "p", "s", "u", t(1), 1.0, "success", 100, None)])
    L.append_runs(led, path)
    L.append_runs(led.withColumn("run_id", F.lit(2).cast("bigint")), path)
    assert L.read_ledger(spark, path).count() == 2


def test_bookmark_round_trip_and_overwrite(spark, scratch):
    path = scratch("bm")
    assert B.load(spark, path).count() == 0
    df = spark.createDataFrame([(i,) for i in range(1, 43)], "id bigint")
    B.save(B.bookmark_of(df, "users", "id"), path)
    assert B.value_for(B.load(spark, path), "users") == "42"
    B.save(B.bookmark_of(spark.createDataFrame([(99,)], "id bigint"), "users", "id"), path)
    assert B.value_for(B.load(spark, path), "users") == "99"


def test_incremental_and_full(spark):
    df = spark.createDataFrame([(i, t(i)) for i in range(1, 6)], "id bigint, ts timestamp_ntz")
    bm = spark.createDataFrame([("s", "ts", "2024-01-01T03:00:00.000000")], B.BOOKMARK_DDL)
    rows, new = B.incremental(df, "s", "ts", bm)
    assert sorted(r["id"] for r in rows.collect()) == [4, 5]
    assert new.first()["value"] == "2024-01-01T05:00:00.000000"
    rows, new = B.incremental(df.where("id < 3"), "s", "ts", bm)
    assert rows.count() == 0 and new.first()["value"] == "2024-01-01T03:00:00.000000"
    rows, _ = B.incremental(df, "s", "ts", bm, full=True)
    assert rows.count() == 5


def test_runs_of_several_streams(spark):
    import datetime as dt

    from feedlake.operators import ledger as L

    t = dt.datetime(2024, 5, 1, 8)
    rows = [("r1", "p", "s", x, t, 14.02, ok, n, err) for x, ok, n, err in (("a", "success", 6, None), ("b", "failure", 3, "boom"), ("c", "success", 2, None))]
    rows += [("r0", "p", "s", "a", t - dt.timedelta(hours=1), 2.0, "success", 1, None)]
    led = spark.createDataFrame(rows, "run_id string, pipeline string, source string, stream string, started_at timestamp, duration_seconds double, status string, records bigint, error string")
    last = L.run_latest(led).first()
    assert (last["records"], last["duration_seconds"], last["status"], last["error"], last["stream"]) == (11, 14.02, "failure", "boom", "a,b,c")
    assert {r["stream"] for r in L.run_last_n(led, 1).collect()} == {"a", "b", "c"}
    total = L.run_totals(led).first()
    assert (total["total_records"], total["duration_seconds"], total["streams"]) == (12, 16.02, "a=7;b=3;c=2")
    assert tuple(L.run_summary(led).first())[1:] == (1, 1)
