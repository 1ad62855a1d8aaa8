"""Landing, reading back and transforms."""

import json

import pandas as pd
import pytest
from pyspark.sql import functions as F

from feedlake.operators import land as K
from feedlake.operators import transform as T
from feedlake.sources import fs


def test_full_overwrite_leaves_no_stale_rows(spark, scratch):
    path = scratch("full")
    K.land_full(spark.range(100), path, max_records=10)
    K.land_full(spark.range(5), path)
    assert spark.read.parquet(path).count() == 5


def _late(df):
    """Rows whose computation fails in the write job only."""
    return df.select(F.when(F.col("id") >= 0, F.raise_error(F.lit("late"))).cast("bigint").alias("id"))


def test_a_failing_replacement_keeps_the_old_rows(spark, scratch):
    root = scratch("keep")
    ten = spark.range(10).withColumn("k", F.col("id") % 2)
    bad = _late(spark.range(5)).withColumn("k", F.lit(1))
    lands = {
        "full": K.land_full, "by": lambda df, p: K.land_partitioned_by(df, p, ["k"]),
        "csv": lambda df, p: K.export(df, p, "csv"), "json": lambda df, p: K.export(df, p, "json"),
    }
    for name, land in lands.items():
        land(ten, f"{root}/{name}")
        with pytest.raises(Exception, match="late"):
            land(bad, f"{root}/{name}")
        back = spark.read.format(name if name in ("csv", "json") else "parquet").load(f"{root}/{name}")
        assert back.count() - (name == "csv") * sum(1 for r in back.collect() if r[0] == "id") == 10
        assert not fs.exists(spark, f"{root}/_replacing")
    with pytest.raises(Exception, match="late"):
        K.land_full(bad, f"{root}/fresh")  # nothing there before: nothing after
    assert not fs.exists(spark, f"{root}/fresh")
    K.land_full(spark.read.parquet(f"{root}/full").where("id < 3"), f"{root}/full")  # a table rewritten from itself
    assert spark.read.parquet(f"{root}/full").count() == 3


def test_a_replacement_cut_off_between_its_renames(spark, scratch):
    from feedlake.operators import publish

    root = scratch("cut")
    path, work = f"{root}/table", f"{root}/_replacing/table/x"
    K.land_full(spark.range(10), path)
    # as a driver that is lost after the first rename leaves it
    fs.write_bytes(spark, f"{work}/new/part", b"")
    assert fs.rename(spark, path, f"{work}/old")
    assert publish.recover(spark, path) and spark.read.parquet(path).count() == 10
    assert not publish.recover(spark, path)
    K.land_full(spark.range(4), path)
    assert spark.read.parquet(path).count() == 4


def test_a_replacement_beside_others(spark, scratch):
    from feedlake.operators import publish

    root = scratch("beside")
    aside = f"{root}/_replacing"

    def write(folder):
        fs.write_bytes(spark, f"{aside}/a/begun", b"")
        fs.delete(spark, f"{aside}/a")  # this one has nothing in the shared folder when the other ends
        publish.replace(spark, f"{root}/b", lambda f: fs.write_bytes(spark, f"{f}/x", b"b"))
        assert fs.exists(spark, aside) and fs.exists(spark, f"{root}/b/x")
        fs.write_bytes(spark, f"{folder}/x", b"a")

    publish.replace(spark, f"{root}/a", write)
    assert fs.exists(spark, f"{root}/a/x") and not fs.exists(spark, aside)


def test_deleting_a_folder_that_another_driver_deletes_or_fills(spark, scratch, monkeypatch):
    root, plain = scratch("late"), fs._fs
    fs.write_bytes(spark, f"{root}/full/x", b"")

    class Early:
        """What was true a moment ago: the folder is there, with nothing in it."""

        def __init__(self, real, empty):
            self.exists, self.delete = lambda p: True, real.delete
            self.listStatus = (lambda p: []) if empty else real.listStatus

    for name, empty in (("gone", False), ("gone", True), ("full", True)):
        monkeypatch.setattr(fs, "_fs", lambda s, p, empty=empty: (Early(plain(s, p)[0], empty), plain(s, p)[1]))
        fs.delete_empty(spark, f"{root}/{name}")
    monkeypatch.undo()
    assert fs.exists(spark, f"{root}/full/x")


def test_increments_keyed_by_run(spark, scratch):
    path = scratch("runs")
    K.land_incremental(spark.range(3), path, "2024-01-01", run="r1")
    K.land_incremental(spark.range(2), path, "2024-01-01", run="r2")
    K.land_incremental(spark.range(3), path, "2024-01-02", run="r1")  # the same run, tried again the next day
    got = {str(r["dt"]): r["count"] for r in K.read_table(spark, path).groupBy("dt").count().collect()}
    assert got == {"2024-01-01": 2, "2024-01-02": 3}
    K.land_incremental(spark.range(0), path, "2024-01-02", run="r1")  # and again, with nothing
    assert K.read_table(spark, path).count() == 2
    with pytest.raises(ValueError, match="keyed by run"):
        K.land_incremental(spark.range(2), path, "2024-01-03")


def test_incremental_after_full_is_refused(spark, scratch):
    path = scratch("mixed")
    K.land_full(spark.range(3), path)
    with pytest.raises(ValueError, match="full"):
        K.land_incremental(spark.range(2), path, "2024-01-01")
    assert spark.read.parquet(path).count() == 3


def test_incremental_appends_per_run_date(spark, scratch):
    path = scratch("inc")
    K.land_incremental(spark.range(3), path, "2024-01-01")
    K.land_incremental(spark.range(2), path, "2024-01-01")  # same day: appended, not replaced (D5)
    K.land_incremental(spark.range(4), path, "2024-01-02")
    got = {str(r["dt"]): r["count"] for r in spark.read.parquet(path).groupBy("dt").count().collect()}
    assert got == {"2024-01-01": 5, "2024-01-02": 4}


@pytest.mark.parametrize("codec", K.CODECS)
def test_codecs(spark, scratch, codec):
    path = scratch(codec)
    K.land_full(spark.range(50), path, codec)
    assert spark.read.parquet(path).count() == 50


def test_bounded_files(spark, scratch):
    path = scratch("bounded")
    K.land_full(spark.range(0, 25000, 1, 1), path, max_records=K.BATCH_ROWS)
    per_file = [r["n"] for r in spark.read.parquet(path).groupBy("_metadata.file_name").agg(F.count("*").alias("n")).collect()]
    assert sorted(per_file) == [5000, 10000, 10000]


def test_tree_first_schema_and_corrupt_files(spark, scratch):
    root = scratch("tree")
    spark.createDataFrame([(1, "a")], "id bigint, x string").write.parquet(f"{root}/a")
    spark.createDataFrame([(2, 5)], "id bigint, y int").write.parquet(f"{root}/b/dt=2024-01-01")
    fs.write_bytes(spark, f"{root}/0_junk.parquet", b"junk")
    df = K.read_tree(spark, root, ignore_corrupt=True)
    counts = K.tree_file_counts(df)  # Spark may also write empty part files: they count as without rows
    assert counts["files_with_rows"] == 2 and counts["files_without_rows"] >= 1
    assert counts["files_listed"] == counts["files_with_rows"] + counts["files_without_rows"]
    assert df.columns == ["id", "x"]
    assert sorted(map(tuple, df.collect())) == [(1, "a"), (2, None)]


def test_files_that_break_off_are_listed_and_left_out(spark, scratch):
    from feedlake import pipeline as P
    from feedlake.operators import ledger as L

    root, lake = scratch("audit"), scratch("lake")
    spark.range(1000).selectExpr("id", "uuid() as u").coalesce(1).write.parquet(f"{root}/a")
    spark.range(50).selectExpr("id", "'x' as more").coalesce(1).write.parquet(f"{root}/b")
    fs.write_bytes(spark, f"{root}/c/junk.parquet", b"junk")
    whole = next(fs.iter_files(spark, f"{root}/a")).removeprefix("file:")
    data = open(whole, "rb").read()
    fs.write_bytes(spark, f"{root}/c/torn.parquet", data[:-100])  # footer gone
    spoilt = bytearray(data)
    spoilt[len(data) // 2 : len(data) // 2 + 4000] = bytes(4000)  # footer fine, pages not
    fs.write_bytes(spark, f"{root}/c/spoilt.parquet", bytes(spoilt))
    fs.write_bytes(spark, f"{root}/c/empty.parquet", b"")
    df, audit = K.read_audited(spark, root)
    found = {r["file"].rpartition("/")[2]: r for r in audit.collect()}
    assert {n for n, r in found.items() if not r["readable"]} == {"junk.parquet", "torn.parquet", "spoilt.parquet", "empty.parquet"}
    assert all(r["reason"] for r in found.values() if not r["readable"])
    assert sorted(r["rows"] for r in found.values() if r["readable"]) == [50, 1000]
    assert df.count() == 1050 and df.columns == ["id", "u"]
    assert K.read_audited(spark, root, merge=True)[0].columns == ["id", "u", "more"]
    assert K.read_audited(spark, f"{root}/c")[0] is None
    assert K.read_tree(spark, f"{root}/a", merge=True).columns == ["id", "u"]
    res = P.run_table(spark, df, lake, "tree", "t", "tp", audit=audit)
    row = L.read_ledger(spark, f"{lake}/_ledger").first()
    assert res.success and (row["records"], row["files_skipped"]) == (1050, 4)
    assert spark.read.parquet(f"{lake}/tree/_rejects/t.files").count() == 4


def test_fan_out_files_follow_the_data(spark, scratch, lines):
    feed = [json.dumps({"type": "RECORD", "stream": f"s{i % 40}", "record": {"id": i}}) for i in range(4000)]
    env = lines(feed).repartition(16)
    staged_path = scratch("staged")
    from feedlake.operators.ingest import stage_envelope, staged_streams

    staged = stage_envelope(env, staged_path)
    assert len(staged.inputFiles()) <= 2 * 40  # not 16 tasks x 40 streams
    assert staged_streams(staged) == sorted(f"s{i}" for i in range(40))
    res = K.fan_out(spark, env, scratch("lake"), "src", concurrent=8).streams
    assert {s: r["rows_out"] for s, r in res.items()} == {f"s{i}": 100 for i in range(40)}


def test_union_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "id bigint, a string")
    b = spark.createDataFrame([(2, 3.5)], "id bigint, b double")
    assert sorted(map(tuple, K.union_all([a, b]).collect())) == [(1, "x", None), (2, None, 3.5)]


def test_fan_out_counts_and_empty_stream(spark, scratch, lines):
    schema = {"properties": {"id": {"type": "integer"}}}
    feed = [
        json.dumps({"type": "SCHEMA", "stream": "a", "schema": schema}),
        json.dumps({"type": "SCHEMA", "stream": "empty", "schema": schema}),
    ] + [json.dumps({"type": "RECORD", "stream": "a", "record": {"id": i}}) for i in range(10)] + [
        json.dumps({"type": "RECORD", "stream": "b", "record": {"id": 1, "z": "q"}})]
    feed += ['{"type": "RECORD", "stream": "a", "record": {"id": "x"}}', "not json"]
    root = scratch("lake")
    out = K.fan_out(spark, lines(feed), root, "src", transform=lambda df, s: df.where("id >= 5") if s == "a" else df)
    res = out.streams
    assert (res["a"]["rows_raw"], res["a"]["rows_out"], res["a"]["rejected"]) == (10, 5, 1)
    assert res["b"]["columns"] == ["id", "z"]  # no SCHEMA: inferred
    assert res["empty"]["rows_raw"] == 0 and res["empty"]["path"] is None
    assert spark.read.parquet(res["a"]["path"]).count() == 5
    assert out.rejected_lines == 1
    assert spark.read.parquet(f"{root}/src/_rejects/_lines").first()["reject_reason"] == "malformed"
    assert spark.read.parquet(f"{root}/src/_rejects/a").first()["errors"] == ["mismatch:id"]


def test_failsafe_transforms(spark, scratch):
    df = spark.range(10)
    out, err = T.apply_failsafe(df, lambda d: d.select("missing_column"))
    assert out is df and "missing_column" in err
    out, err = T.apply_failsafe(df, lambda d: None)
    assert out is df and err
    path = scratch("failsafe")
    res = T.land_failsafe(df, lambda d: d.withColumn("id", F.raise_error(F.lit("bad"))), path)
    assert res["transformed"] is False and spark.read.parquet(path).count() == 10
    assert T.land_failsafe(df, lambda d: d.where("id < 3"), path)["transformed"]
    with pytest.raises(Exception, match="late"):  # the raw rows fail too: the old ones stay
        T.land_failsafe(_late(df), lambda d: d.where("id < 5"), path)
    assert spark.read.parquet(path).count() == 3
    res = T.land_failsafe(df, lambda d: d.where("id < 3"), path)
    assert res["transformed"] and spark.read.parquet(path).count() == 3


def test_batched_transform_failsafe_per_batch(spark):
    df = spark.range(0, 100, 1, 4)

    def fn(pdf: pd.DataFrame):
        if pdf["id"].min() == 0:
            raise ValueError("first batch fails")
        return pdf[pdf["id"] % 2 == 0]

    got = T.apply_batched(df, fn).count()
    assert got == 25 + sum(1 for i in range(25, 100) if i % 2 == 0)  # first batch kept raw, the rest filtered


def test_export_formats_round_trip(spark, scratch):
    rep = spark.createDataFrame([("2024-01", 10.5), ("2024-02", None)], "month string, revenue double")
    for fmt in ("csv", "json", "parquet"):
        path = scratch(f"export_{fmt}")
        K.export(rep, path, fmt)
        reader = spark.read.schema("month string, revenue double")
        back = reader.option("header", True).csv(path) if fmt == "csv" else getattr(reader, fmt)(path)
        assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, rep.collect()), key=str)
    with pytest.raises(ValueError):
        K.export(rep, scratch("x"), "xml")
