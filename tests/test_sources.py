"""Delimited sources and type inference (S5-S11), JDBC (S12) and new-file pickup."""

import pytest
from pyspark.sql import functions as F

from feedlake.functions import bool_token, clean_text, decimal_comma, source_name, table_name, log_key
from feedlake.sources import delimited as D
from feedlake.sources import jdbc as J
from feedlake.streaming.pickup import pickup_available


def _sheet(spark, rows, cols):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], ["pos"] + cols)
    return df


def test_sheet_inference_rules(spark):
    cols = ["i", "n", "b", "s", "e"]
    rows = [("1", "1,5", "sim", "x", ""), (" 2 ", "2", "nao", "3", ""), ("", "3.25", "1", "y", " ")]
    types = {r["column_name"]: r["json_type"] for r in D.sheet_types(_sheet(spark, rows, cols), cols).collect()}
    assert types == {"i": "integer", "n": "number", "b": "boolean", "s": "string", "e": "string"}
    cast = D.sheet_cast(_sheet(spark, rows, cols), types).collect()
    assert cast[0]["n"] == 1.5 and cast[1]["i"] == 2 and cast[2]["i"] is None
    assert [r["b"] for r in cast] == [True, False, True]


def test_sheet_rejects_list_cells_that_do_not_fit(spark):
    cols = ["i", "b"]
    rows = [(str(i), "sim") for i in range(20)] + [("x1", "maybe"), ("", "nao")]
    sheet = _sheet(spark, rows, cols)
    found = {r["column_name"]: r["json_type"] for r in D.sheet_types(sheet, cols).collect()}
    assert found == {"i": "string", "b": "string"}  # every row counts
    types = {"i": "integer", "b": "boolean"}
    bad = sorted((r["column_name"], r["val"]) for r in D.sheet_rejects(sheet, types).collect())
    assert bad == [("b", "maybe"), ("i", "x1")]


def test_late_misfit_changes_the_type(spark):
    rows = [(str(i), str(i)) for i in range(300)]
    sheet = _sheet(spark, rows + [("", "text")], ["c", "d"])
    for infer in (D.sheet_types, D.majority_types):
        assert [r["json_type"] for r in infer(sheet, ["c", "d"]).collect()] == ["integer", "string"]
    many = _sheet(spark, rows[:100] + [("0.5", "true")] * 200, ["c", "d"])
    assert [r["json_type"] for r in D.majority_types(many, ["c", "d"]).collect()] == ["number", "boolean"]


def test_quoted_text(spark, scratch):
    path = scratch("quoted")
    spark.createDataFrame([("t,n",), ('"he said ""hi"", ok",1',)], ["value"]).coalesce(1).write.text(path)
    assert [tuple(r) for r in D.read_csv(spark, path, with_pos=False).collect()] == [('he said "hi", ok', "1")]


def test_majority_inference_and_ties(spark):
    cols = ["m", "t", "s"]
    rows = [("1", "true", "a"), ("1.5", "1", "1"), ("2.5", "false", "2"), ("3", "2", "")]
    types = {r["column_name"]: r["json_type"] for r in D.majority_types(_sheet(spark, rows, cols), cols).collect()}
    # m: 2 integer vs 2 number, integer seen first; t: boolean 2 vs integer 2, boolean first; s has a string
    assert types == {"m": "integer", "t": "boolean", "s": "string"}
    cast = D.majority_cast(_sheet(spark, rows, cols), types).collect()
    assert [r["m"] for r in cast] == [1, None, None, 3]
    assert [r["t"] for r in cast] == [True, False, False, False]


def test_csv_header_cleaning(spark, scratch):
    path = scratch("csv")
    df = spark.createDataFrame([(1, "a")], ["\ufeff id ", " name"])
    df.write.option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    got = D.read_csv(spark, path, with_pos=False)
    assert got.columns == ["id", "name"] and got.first()["name"] == "a"


def test_prefix_pattern(spark, scratch):
    root = scratch("prefix")
    for name in ("orders_a", "orders_b", "people"):
        spark.createDataFrame([(name,)], ["v"]).write.option("header", True).csv(f"{root}/{name}")
    got = sorted(r["v"] for r in D.read_matching(spark, root, r"/orders_[a-z]/").collect())
    assert got == ["orders_a", "orders_b"]


def test_scalar_helpers(spark):
    row = spark.range(1).select(
        clean_text(F.lit("  MiXed \t")).alias("a"),
        decimal_comma(F.lit("1,25")).alias("b"),
        decimal_comma(F.lit("1,234.5")).alias("c"),
        bool_token(F.lit(" Sim ")).alias("d"),
        bool_token(F.lit("maybe")).alias("e"),
        source_name(F.lit("python /opt/taps/tap-postgres.py")).alias("f"),
        table_name(F.lit("My Sheet-1")).alias("g"),
        log_key(F.lit("2024-01-02 03:04:05").cast("timestamp_ntz")).alias("h"),
    ).first()
    assert tuple(row) == ("mixed", 1.25, None, True, None, "postgres", "my_sheet_1", "2024-01-02T03-04-05")


def test_jdbc_partitioned_incremental(spark):
    url = J.embedded_url("t")
    J.write_table(spark.range(1, 101).withColumn("v", F.col("id") * 2), url, "T1")
    df = J.read_partitioned(spark, url, "T1", "id", num_partitions=4, newer_than=90)
    assert df.rdd.getNumPartitions() == 4
    assert sorted(r["id"] for r in df.collect()) == list(range(91, 101))


def test_pickup_only_new_files(spark, scratch):
    root = scratch("inbox")
    line = '{"type": "RECORD", "stream": "s", "record": {"id": 1}}'
    spark.createDataFrame([(line,)] * 12, ["value"]).write.text(f"{root}/in/a")
    first = pickup_available(spark, f"{root}/in", f"{root}/sink", f"{root}/cp")
    spark.createDataFrame([(line,)], ["value"]).write.text(f"{root}/in/b")
    second = pickup_available(spark, f"{root}/in", f"{root}/sink", f"{root}/cp")
    assert (first["rows"], second["rows"]) == (12, 1)
    assert spark.read.parquet(f"{root}/sink").count() == 13


def _files(spark, root, files):
    from feedlake.sources import fs

    for name, text in files.items():
        fs.write_bytes(spark, f"{root}/{name}", text.encode())
    return root


def test_each_file_is_read_by_its_own_header(spark, scratch):
    files = {"a.csv": "\ufeff id ,name\n1,x\n2,y\n", "sub/b.csv": "name,id\nm,3\n", "c.csv": "id,age\n4,9\n", "empty.csv": "", "head.csv": "\n\nid,name\n", "blank.csv": " \n"}
    root = _files(spark, scratch("own"), files)
    df = D.read_csv(spark, root)
    assert df.columns[-1] == "pos" and set(df.columns) == {"id", "name", "age", "pos"}
    got = sorted((r["id"], r["name"], r["age"]) for r in df.collect())
    assert got == [("1", "x", None), ("2", "y", None), ("3", "m", None), ("4", None, "9")]
    first = D.read_csv(spark, root, pattern="/a[.]csv$", with_pos=False)
    assert first.columns == ["id", "name"] and first.count() == 2  # other files' headers play no part
    assert D.read_csv(spark, f"{root}/a.csv", with_pos=False, columns=["k", "v"]).columns == ["k", "v"]
    assert D.read_csv(spark, f"{root}/empty.csv", with_pos=False).count() == 0


def test_quotes_line_breaks_and_odd_headers(spark, scratch):
    text = 'id,"say, ""it""",id,\n1,"a ""q"" b",2,z\n3,"two\nlines, one field",4,\n'
    root = _files(spark, scratch("quotes"), {"t.csv": text})
    df = D.read_csv(spark, root, with_pos=False, multi_line=True)
    assert df.columns == ["id0", 'say, "it"', "id2", "_c3"]
    assert sorted(map(tuple, df.collect())) == [("1", 'a "q" b', "2", "z"), ("3", "two\nlines, one field", "4", None)]
    assert D.read_matching(spark, root, "t.csv", multi_line=True).collect() == df.collect()


def test_entities_hand_their_keys_to_the_transform(spark, scratch):
    from feedlake import pipeline as P

    root = _files(spark, scratch("entities"), {"p/1.csv": "sku,size,n\na,1,5\na,1,6\na,2,7\n", "q/1.csv": "code\nx\nx\n"})
    entities = {"parts": D.Entity(f"{root}/p", ("sku", "size")), "codes": f"{root}/q"}
    lake = scratch("lake")
    res = P.run_entities(spark, entities, lake, "csv", "parts_pipe", transform=lambda df, name, keys: df.dropDuplicates(list(keys)) if keys else df)
    assert {n: r.streams[n] for n, r in res.items()} == {"parts": 2, "codes": 2}
    assert spark.read.parquet(f"{lake}/csv/parts").count() == 2
    with pytest.raises(ValueError, match="colour"):
        D.read_entities(spark, {"parts": D.Entity(f"{root}/p", ("colour",))})


def test_misfits_are_listed_and_landed(spark, scratch):
    from feedlake import pipeline as P

    df = spark.createDataFrame([(0, "1", "a"), (1, "2", ""), (2, "true", "b"), (3, "", "c")], "pos int, n string, s string")
    types = {r["column_name"]: r["json_type"] for r in D.majority_types(df, ["n", "s"]).collect()}
    assert types == {"n": "integer", "s": "string"}
    bad = D.majority_rejects(df, types)
    assert [tuple(r) for r in bad.collect()] == [(2, "n", "true")]
    lake = scratch("lake")
    res = P.run_table(spark, D.majority_cast(df, types), lake, "csv", "t", "tp", rejects=bad)
    assert res.success and res.streams == {"t": 4} and res.rejected_lines == 1
    assert spark.read.parquet(f"{lake}/csv/_rejects/t.cells").first()["val"] == "true"
    assert D.majority_rejects(df, {"s": "string"}).count() == 0


def test_majority_kind_is_worked_out_once_per_cell(spark):
    df = spark.createDataFrame([(0, "1", "a")], "pos int, n string, s string")
    plan = D.majority_types(df, ["n", "s"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RLIKE") <= 4


def test_jdbc_ranges_of_skewed_text_and_time_keys(spark):
    import datetime as dt

    rows = [(i * i * i, f"k'{i % 7:03d}{i:04d}", dt.datetime(2024, 1, 1) + dt.timedelta(seconds=i * i), i) for i in range(400)]
    rows += [(None, "zz", None, -1)] + [(8, "k'0000002", dt.datetime(2024, 1, 1, 0, 0, 4), -2)] * 30
    df = spark.createDataFrame(rows, "num bigint, txt string, at timestamp_ntz, n int")
    url = J.embedded_url("ranges")
    J.write_table(df, url, "T", column_types="txt VARCHAR(64)")  # Derby cannot order the long text of its default
    for key, mark in (("num", 1000), ("txt", "k'0010"), ("at", dt.datetime(2024, 1, 1, 1))):
        whole = J.read_partitioned(spark, url, "T", key, num_partitions=8)
        assert sorted(map(str, whole.collect())) == sorted(map(str, df.collect()))  # the row without a key too
        sizes = [r["count"] for r in whole.groupBy(F.spark_partition_id()).count().collect()]
        assert 6 <= len(sizes) <= 9 and max(sizes) <= 2 * -(-431 // 8)
        newer = J.read_partitioned(spark, url, "T", key, num_partitions=4, newer_than=mark)
        assert sorted(map(str, newer.collect())) == sorted(map(str, df.where(F.col(key) > F.lit(mark)).collect()))
        ranges = J.key_ranges(spark, url, "T", key, 4, mark)
        assert len(ranges) == 4 and all(f"> {J.literal(mark)}" in r for r in ranges)
    assert J.read_partitioned(spark, url, "T", "num", newer_than=10**12).count() == 0
    assert J.key_ranges(spark, url, "T", "num", 1) == ["1 = 1"]


def test_pickup_counts_more_batches_than_progress_keeps(spark, scratch):
    import json

    from feedlake.operators import envelope as E

    root = scratch("inbox")
    schema = lambda n: json.dumps({"type": "SCHEMA", "stream": "s", "schema": {"properties": {f"c{n}": {"type": "integer"}}}, "key_properties": ["k"]})
    files = {f"in/{n:03d}.txt": f'{schema(n)}\n\n{{"type": "RECORD", "stream": "s", "record": {{"id": {n}}}}}\n' for n in range(104)}
    _files(spark, root, files)
    first = pickup_available(spark, f"{root}/in", f"{root}/sink", f"{root}/cp", max_files=1)
    assert (first["rows"], first["batches"]) == (208, 104)
    _files(spark, root, {"in/000-late.txt": schema("late") + "\n"})
    second = pickup_available(spark, f"{root}/in", f"{root}/sink", f"{root}/cp")
    assert (second["rows"], second["batches"]) == (1, 1)
    assert pickup_available(spark, f"{root}/in", f"{root}/sink", f"{root}/cp")["rows"] == 0
    env = spark.read.parquet(f"{root}/sink")
    latest = E.schema_map(env)["s"]
    assert list(latest["schema"]["properties"]) == ["clate"] and latest["key_properties"] == ["k"]
