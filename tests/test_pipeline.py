"""End-to-end runs, after the reference's engine tests: fake source -> lake,
layout, failure handling, state and ledger."""

import json

from pyspark.sql import functions as F

from feedlake import pipeline as P
from feedlake.operators import bookmarks as B
from feedlake.operators import land as K
from feedlake.operators import ledger as L
from feedlake.operators.publish import published
from feedlake.sources import fs

from .test_envelope import HALL_FEED, HALL_STATE, _line


def _feed(spark, scratch, lines):
    path = scratch("feed")
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    return path


def test_run_lands_table_state_and_ledger(spark, scratch):
    lake = scratch("lake")
    res = P.run(spark, _feed(spark, scratch, HALL_FEED), lake, "mock", "hall")
    assert res.success and res.error is None
    assert res.streams == {"machines": 4, "stops": 5} and res.schemas["stops"] == ["began", "hall", "minutes"]
    back = spark.read.parquet(f"{lake}/mock/machines")
    assert back.count() == 4 and back.where(F.col("spec").isNull()).count() == 2
    assert "dt" not in back.columns  # full runs are not partitioned
    assert json.loads(P.load_state(spark, lake, "hall")) == HALL_STATE
    runs = L.read_ledger(spark, f"{lake}/_ledger")
    assert sorted((r["stream"], r["status"], r["records"], r["records_raw"], r["rejected"]) for r in runs.collect()) == [
        ("machines", "success", 4, 4, 0), ("stops", "success", 5, 5, 0)]
    cat = {r["stream"]: r for r in L.manifest_rollup(runs).collect()}
    assert (cat["stops"]["source"], cat["stops"]["total_rows"], cat["stops"]["extractions"]) == ("mock", 5, 1)
    assert [tuple(c) for c in cat["stops"]["columns"]] == [("began", "timestamp_ntz", True), ("hall", "string", True), ("minutes", "bigint", True)]
    totals = L.totals_by_run(runs).first()
    assert totals["total_records"] == 9 and totals["streams"] == "machines=4;stops=5"


def test_incremental_run_partitions_by_run_date(spark, scratch):
    lake = scratch("lake")
    feed = _feed(spark, scratch, HALL_FEED)
    P.run(spark, feed, lake, "mock", "p", incremental=True, run_date="2024-05-01")
    again = P.run(spark, feed, lake, "mock", "p", incremental=True, run_date="2024-05-01")  # same day: appended
    assert again.streams == {"machines": 4, "stops": 3}  # only stops above the STATE's bookmark; machines have none
    back = K.read_table(spark, f"{lake}/mock/stops")
    assert back.count() == 8 and [str(r["dt"]) for r in back.select("dt").distinct().collect()] == ["2024-05-01"]
    assert back.columns == ["began", "hall", "minutes", "dt"]
    assert fs.exists(spark, f"{lake}/mock/stops/dt=2024-05-01")
    whole = P.run(spark, feed, lake, "mock", "p", incremental=True, full=True, run_date="2024-05-02")
    assert whole.streams == {"machines": 4, "stops": 5}


def test_bookmarks_of_landed_rows(spark, scratch):
    lake, rows = scratch("lake"), [{"k": i, "s": f"x{i}"} for i in (1, 2, 10)]
    schema = {"properties": {"k": {"type": "integer"}, "s": {"type": "string"}}}
    feed = lambda recs: _feed(spark, scratch, [_line("SCHEMA", stream=t, schema=schema) for t in ("t", "u")] + [_line("RECORD", stream=t, record=r) for t in ("t", "u") for r in recs])
    run = lambda recs, **kw: P.run(spark, feed(recs), lake, "m", "p", bookmark_keys={"t": "k"}, incremental=True, **kw)
    assert run(rows).streams == {"t": 3, "u": 3}
    later = rows + [{"k": 9, "s": "late"}, {"k": 11, "s": "new"}, {"k": "12", "s": "text"}, {"s": "no key"}, {"k": "x", "s": "odd"}]
    second = run(later)
    # 9 < 10 as numbers; records without a comparable key are set aside, not lost and not landed each time
    assert second.streams["t"] == 2 and second.rejected_lines == 2
    why = spark.read.parquet(f"{lake}/m/_rejects/_lines")
    assert [r["reject_reason"] for r in why.collect()] == ["bookmark_key"] * 2
    assert run(later).streams["t"] == 0 and run(later, full=True).streams["t"] == 6
    assert {r["stream"]: r["value"] for r in B.load(spark, f"{lake}/_state/p").collect()} == {"t": "12"}


def test_state_shapes():
    schemas = {"a": {"key_properties": ["id"], "schema": {"properties": {"at": {"type": "string", "format": "date-time"}}}}}
    marks = B.from_state(json.dumps({"bookmarks": {
        "a": {"at": "2024-01-01T00:00:00Z"}, "b": {"replication_key": "n", "replication_key_value": 7, "version": 3},
        "c": {"x": 1, "y": 2}, "d": {}, "e": None, "f": {"flag": True}, "g": 5}}), schemas)
    assert marks == [("a", "at", "2024-01-01T00:00:00Z", "time"), ("b", "n", "7", "number")]
    assert B.from_state('{"a": 5}', schemas) == [("a", "id", "5", "number")]
    assert B.from_state("[1]", schemas) == B.from_state(None, schemas) == B.from_state("not json", schemas) == []


def test_times_compare_as_times(spark, lines):
    marks = spark.createDataFrame([("t", "at", "2024-01-01T10:00:00Z", "time")], B.KINDED_DDL)
    at = ["2024-01-01T09:00:00Z", "2024-01-01T10:00:00.000Z", "2024-01-01T09:30:00-02:00", "2024-01-01T11:00:00+02:00", "2024-01-01 10:00:01"]
    env = lines([_line("RECORD", stream="t", record={"at": a}) for a in at] + [_line("RECORD", stream="u", record={"at": at[0]}), "junk"])
    kept = B.newer_records(env, marks).collect()
    assert [json.loads(r["record"])["at"] for r in kept if r["stream"] == "t"] == [at[2], at[4]]
    assert len(kept) == 4 and [r["reject_reason"] for r in kept if r["reject_reason"]] == ["malformed"]


def _dies(stream, times):
    """A transform that lets the run die at the write of ``stream``, so many times."""
    left = [times]

    def fn(df, s):
        if s == stream and left[0]:
            left[0] -= 1
            raise KeyboardInterrupt("killed")
        return df

    return fn


def test_a_run_tried_again_lands_each_row_once(spark, scratch):
    import pytest

    lake, feed = scratch("lake"), _feed(spark, scratch, HALL_FEED)
    with pytest.raises(KeyboardInterrupt):  # the driver is lost after machines landed
        P.run(spark, feed, lake, "mock", "p", incremental=True, run_date="2024-05-01", run_id=77, transform=_dies("stops", 1))
    assert K.read_table(spark, f"{lake}/mock/machines").count() == 4
    ledger = f"{lake}/_ledger"
    assert not fs.exists(spark, ledger)
    done = P.run(spark, feed, lake, "mock", "p", incremental=True, run_date="2024-05-02", run_id=77)
    assert done.success and done.run_id == 77
    for stream, n in (("machines", 4), ("stops", 5)):
        assert K.read_table(spark, f"{lake}/mock/{stream}").count() == n
        assert [str(r["dt"]) for r in K.read_table(spark, f"{lake}/mock/{stream}").select("dt").distinct().collect()] == ["2024-05-02"]
    same = P.run(spark, feed, lake, "mock", "p", incremental=True, run_id=77)  # succeeded already: nothing is done
    assert same.success and same.streams == {"machines": 4, "stops": 5}
    new = P.run(spark, feed, lake, "mock", "p", incremental=True, full=True)
    assert new.run_id != 77 and K.read_table(spark, f"{lake}/mock/stops").count() == 10
    runs = L.read_ledger(spark, ledger)
    assert runs.count() == 4 and L.runs(runs).count() == 2


def test_only_runs_in_the_ledger_are_published(spark, scratch):
    import pytest

    lake, feed = scratch("lake"), _feed(spark, scratch, HALL_FEED)
    P.run(spark, feed, lake, "mock", "p", incremental=True, run_id=1)
    with pytest.raises(KeyboardInterrupt):
        P.run(spark, feed, lake, "mock", "p", incremental=True, full=True, run_id=2, transform=_dies("stops", 1))
    table = spark.read.parquet(f"{lake}/mock/machines")
    assert table.count() == 8  # four of a run that never ended
    seen = published(table, L.read_ledger(spark, f"{lake}/_ledger"))
    assert seen.count() == 4 and "_run" not in seen.columns


def test_columns_drift_is_in_the_ledger(spark, scratch):
    lake = scratch("lake")
    schemas = [{"a": "integer", "b": "string"}, {"a": "integer", "b": "string"}, {"a": "number", "c": "boolean"}]
    for n, props in enumerate(schemas):
        schema = {"properties": {k: {"type": t} for k, t in props.items()}}
        rec = {k: {"integer": 1, "string": "x", "number": 1.5, "boolean": True}[t] for k, t in props.items()}
        feed = [_line("SCHEMA", stream="t", schema=schema), _line("RECORD", stream="t", record=rec)]
        P.run(spark, _feed(spark, scratch, feed), lake, "m", "p", run_id=n)
    ledger = L.read_ledger(spark, f"{lake}/_ledger")
    drift = sorted((r["run_id"], r["name"], r["change"], r["old_type"], r["new_type"]) for r in L.schema_drift(ledger).collect())
    assert drift == [(2, "a", "type", "bigint", "double"), (2, "b", "removed", "string", None), (2, "c", "added", None, "boolean")]
    listing = [(r["position"], r["name"], r["type"]) for r in L.manifest_listing(ledger).orderBy("position").collect()]
    assert listing == [(0, "a", "double"), (1, "c", "boolean")]


def test_failed_run_is_recorded_without_state(spark, scratch):
    lake = scratch("lake")
    res = P.run(spark, f"{lake}/no_such_feed", lake, "mock", "broken")
    assert not res.success and res.error
    runs = L.read_ledger(spark, f"{lake}/_ledger").collect()
    assert runs[0]["status"] == "failure" and runs[0]["error"] == res.error
    assert P.load_state(spark, lake, "broken") is None
    assert L.run_failed_latest(L.read_ledger(spark, f"{lake}/_ledger")).count() == 1


def test_stream_allow_list_and_partition_by(spark, scratch):
    lake = scratch("lake")
    res = P.run(spark, _feed(spark, scratch, HALL_FEED), lake, "mock", "p", streams=["machines"], partition_by=["hall", "slot"])
    assert res.success and set(res.streams) == {"machines"}
    assert fs.exists(spark, f"{lake}/mock/machines/hall=B/slot=1")
    assert not fs.exists(spark, f"{lake}/mock/stops")
    inc = P.run(spark, _feed(spark, scratch, HALL_FEED), scratch("lake"), "mock", "p", incremental=True, partition_by=["hall"])
    assert inc.success and inc.streams["machines"] == 4


def test_rows_live_follows_full_and_incremental_runs(spark, scratch):
    lake = scratch("lake")
    feed = _feed(spark, scratch, [x for x in HALL_FEED if "stops" not in x])
    ledger = f"{lake}/_ledger"

    def live():
        return L.rows_live(L.read_ledger(spark, ledger)).first()["rows_live"]

    P.run(spark, feed, lake, "mock", "p", incremental=True, run_date="2024-05-01")
    P.run(spark, feed, lake, "mock", "p", incremental=True, run_date="2024-05-02")
    assert live() == 8
    P.run(spark, feed, lake, "mock", "p")  # a full run replaces the table
    assert live() == 4
    assert L.manifest_rollup(L.read_ledger(spark, ledger)).first()["total_rows"] == 12
    refused = P.run(spark, feed, lake, "mock", "p", incremental=True)  # would hide the full landing
    assert not refused.success and "full" in refused.error
    assert live() == 4 and spark.read.parquet(f"{lake}/mock/machines").count() == 4


def test_table_source_runs_with_bookmarks(spark, scratch):
    lake = scratch("lake")
    src = spark.range(1, 11).withColumnRenamed("id", "k")
    r1 = P.run_table(spark, src.where("k <= 6"), lake, "pg", "t", "tp", bookmark_key="k", incremental=True,
                     run_date="2024-05-01")
    assert r1.success and r1.streams == {"t": 6}
    r2 = P.run_table(spark, src, lake, "pg", "t", "tp", bookmark_key="k", incremental=True, run_date="2024-05-02")
    assert r2.streams == {"t": 4}  # only keys above the saved bookmark
    assert spark.read.parquet(f"{lake}/pg/t").count() == 10
    r3 = P.run_table(spark, src, lake, "pg", "t", "tp", bookmark_key="k", full=True)
    assert r3.streams == {"t": 10} and spark.read.parquet(f"{lake}/pg/t").count() == 10
    led = L.read_ledger(spark, f"{lake}/_ledger")
    assert led.count() == 3 and L.rows_live(led).first()["rows_live"] == 10
    bad = P.run_table(spark, src, lake, "pg", "t", "tp", transform=lambda d: d.select("nope"))
    assert bad.success and "nope" in bad.error  # plan-time transform failure: raw rows landed


def test_two_tables_of_a_pipeline_keep_their_bookmarks(spark, scratch):
    lake = scratch("lake")
    src = spark.range(1, 6).withColumnRenamed("id", "k")
    for stream in ("t", "u", "t"):
        res = P.run_table(spark, src, lake, "pg", stream, "tp", bookmark_key="k", incremental=True)
    assert res.success and res.streams == {"t": 0}
    assert spark.read.parquet(f"{lake}/pg/t").count() == 5
    nulls = spark.createDataFrame([(None,), (9,), (None,)], "k bigint")
    for _ in range(2):  # rows without a key are set aside, those of now, and the others landed
        res = P.run_table(spark, nulls, lake, "pg", "t", "tp", bookmark_key="k", incremental=True)
        assert res.success and res.rejected_lines == 2
        assert spark.read.parquet(f"{lake}/pg/_rejects/t").count() == 2
    assert K.read_table(spark, f"{lake}/pg/t").count() == 6
    saved = B.load(spark, f"{lake}/_bookmarks/tp").collect()
    assert sorted((r["stream"], r["value"]) for r in saved) == [("t", "9"), ("u", "5")]


def test_failing_transforms_land_raw_rows(spark, scratch):
    lake = scratch("lake")

    def at_plan_time(df, stream):
        raise ValueError("no such rule")

    def at_run_time(df, stream):
        return df.withColumn("x", F.raise_error(F.lit("late")))

    for transform, why in ((at_plan_time, "no such rule"), (at_run_time, "late"), (lambda df, s: None, "None")):
        res = P.run(spark, _feed(spark, scratch, HALL_FEED), lake, "mock", "p", streams=["stops"], transform=transform)
        assert res.success and why in res.error and res.streams == {"stops": 5}
        assert "x" not in spark.read.parquet(f"{lake}/mock/stops").columns
    late = P.run_table(spark, spark.range(3), lake, "pg", "t", "tp", transform=lambda d: at_run_time(d, "t"))
    assert late.success and "late" in late.error and spark.read.parquet(f"{lake}/pg/t").count() == 3
    errors = [r["error"] for r in L.read_ledger(spark, f"{lake}/_ledger").collect()]
    assert len(errors) == 4 and all(errors)


def test_odd_stream_names_and_records_that_are_no_objects(spark, scratch):
    lake = scratch("lake")
    names = ["007", "08", "", "control", "__rejects__", "_hidden", "a/b"]
    feed = [json.dumps({"type": "RECORD", "stream": n, "record": {"x": 1}}) for n in names]
    feed.append('{"type": "RECORD", "stream": "08", "record": 5}')
    for day in ("2024-05-01", "2024-05-02"):
        res = P.run(spark, _feed(spark, scratch, feed), lake, "mock", "p", incremental=True, run_date=day)
        assert res.success and res.streams == {n: 1 for n in names if n} and res.rejected_lines == 2
    kept = spark.read.parquet(f"{lake}/mock/_rejects/_lines").groupBy("reject_reason").count().collect()
    assert {r["reject_reason"]: r["count"] for r in kept} == {"missing_key": 2, "record_not_object": 2}
    assert spark.read.parquet(f"{lake}/mock/a%2Fb").count() == 2
    assert spark.read.parquet(f"{lake}/mock/%5Fhidden").count() == 2
