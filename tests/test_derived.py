"""Inputs derived from the tables, and the sorts over them, stay within a task's memory."""

import datetime as dt
import glob

import pytest

from feedlake.operators.clean import dealt_for_sort, dedupe_keep_first
from feedlake.plans import feeds, q_feed, q_sources
from feedlake.plans.registry import QUERIES, load_all
from feedlake.sources import delimited as D

from .test_plans import plan

load_all()

LINEITEM = (
    "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
    "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
)


@pytest.fixture
def tables(spark, scratch):
    """lineitem with keys out of order; every third line comes twice, with a dearer second part."""
    rows = [(k * 37 % 101, k, 1, k % 4, float(k), 10.0, 0.5, 0.0, "RAN"[k % 3], "OF"[k % 2], dt.datetime(1995, 1 + k % 2, 3)) for k in range(300)]
    rows += [(r[0], r[1] + 1000, *r[2:5], 99.0, *r[6:]) for r in rows[::3]]
    d = scratch("tables")
    spark.createDataFrame(rows, LINEITEM).repartition(3).write.parquet(f"{d}/lineitem.parquet")
    return d, rows


def test_majority_csv_is_sorted_in_bounded_parts_and_holds_its_own_columns(spark, tables, monkeypatch):
    d, rows = tables
    monkeypatch.setattr(q_sources, "_SORT_ROWS", 50)
    csv = q_sources._mixed_csv(spark, d)
    assert csv.columns == [*q_sources.MAJ_COLUMNS, "pos"]
    got = [(int(r.order_key), r.status) for r in csv.orderBy("pos").collect()]
    want = sorted(rows, key=lambda r: (r[0], r[3], r[1]))  # the part tells lines of a key apart
    assert got == [(r[0], r[8]) for r in want]
    assert csv.select("pos.file").distinct().count() > 4


def test_headers_are_found_without_a_sort(spark, tables, scratch):
    at = scratch("headers")
    spark.range(50).selectExpr("id", "id + 1 AS b").write.options(header=True).csv(f"{at}/x")
    spark.range(0).selectExpr("id AS c").coalesce(1).write.options(header=True).csv(f"{at}/y")
    found = D.file_headers(spark, at)
    assert "SortAggregate" not in plan(found) and "Sort " not in plan(found)
    assert {r.header for r in found.collect()} == {"id,b", "c"}


def test_feed_files_are_compressed_and_of_bounded_length(spark, tables, scratch, monkeypatch):
    d, rows = tables
    monkeypatch.setattr(feeds, "FILE_LINES", 40)
    path = feeds.write_segments(feeds.VARIANTS["lineitem"][0](spark, d), scratch("feed"))
    files = glob.glob(f"{path.removeprefix('file:')}/seg0001/part-*")
    assert len(files) >= 10 and all(f.endswith(".txt.gz") for f in files)
    read = q_feed.decode_feed(spark, path, "lineitem").rows
    assert sorted(r.l_partkey for r in read.collect()) == sorted(r[1] for r in rows)


def test_month_revenue_is_dealt_once_and_sorted_once(spark, tables, monkeypatch):
    d, rows = tables
    monkeypatch.setattr("feedlake.operators.clean.SORT_ROWS", 50)
    df = QUERIES["feed_month_revenue"](spark, d)
    p = plan(df)
    assert p.count("hashpartitioning(l_orderkey") == 1 and p.count("Sort [l_orderkey") == 1 and "REPARTITION_BY_NUM" in p
    first = {}
    for r in sorted(rows, key=lambda r: r[1]):
        first.setdefault((r[0], r[3]), r)
    want = {m: [r for r in first.values() if r[10].month == m] for m in (1, 2)}
    got = {r.month: (r.revenue, r.n_lines) for r in df.collect()}
    assert got == {f"1995-{m:02d}": (sum(r[5] * 0.5 for r in v), len(v)) for m, v in want.items()}


def test_a_deal_for_a_sort_follows_the_rows(spark, monkeypatch):
    df = spark.range(100).selectExpr("id % 9 AS k", "id")
    monkeypatch.setattr("feedlake.operators.clean.SORT_ROWS", 10)
    dealt = dealt_for_sort(df, ["k"], 100)
    assert dealt.rdd.getNumPartitions() == 10 and dealt_for_sort(df, ["k"], 0).rdd.getNumPartitions() == 1
    assert sorted(r.id for r in dedupe_keep_first(dealt, ["k"], ["id"]).collect()) == list(range(9))
