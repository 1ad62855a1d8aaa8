"""Plan shape checks: the properties the design relies on at scale."""

import os

import pytest

from feedlake.operators.ingest import decode_feed
from feedlake.plans.feeds import fixture
from feedlake.plans.registry import QUERIES, load_all

from .conftest import SF_SMALL

load_all()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="driver tables not present")


def plan(df, mode="simple"):
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


def test_keep_first_limits_each_key_before_the_shuffle(spark):
    p = plan(QUERIES["dedupe_keep_first"](spark, SF_SMALL))
    below_exchange = p[p.index("Exchange hashpartitioning"):]  # the plan prints top-down
    assert "WindowGroupLimit" in below_exchange and "row_number(), 1, Partial" in below_exchange


def test_last_n_runs_limits_before_the_shuffle(spark):
    p = plan(QUERIES["run_last_n"](spark, SF_SMALL))
    assert "dense_rank(" in p and ", 10, Partial" in p


def test_bookmark_and_month_bounds_reach_the_scan(spark):
    p = plan(QUERIES["bookmark_filter"](spark, SF_SMALL), "formatted")
    assert "PushedFilters: [IsNotNull(ts), GreaterThan(ts," in p
    p = plan(QUERIES["filter_month_range"](spark, SF_SMALL), "formatted")
    assert "GreaterThanOrEqual(o_orderdate," in p


def test_projection_prunes_columns(spark):
    p = plan(QUERIES["clean_computed"](spark, SF_SMALL), "formatted")
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_extendedprice:double,l_discount:double>" in p


def test_top_k_is_take_ordered(spark):
    assert "TakeOrderedAndProject" in plan(QUERIES["top_k"](spark, SF_SMALL))


def test_aggregates_are_partial_then_final(spark):
    p = plan(QUERIES["manifest_rollup"](spark, SF_SMALL))
    assert "partial_sum" in p and "partial_count" in p


def test_feed_decode_parses_each_line_once(spark):
    rows = decode_feed(spark, fixture(spark, SF_SMALL, "lineitem"), "lineitem").rows
    p = plan(rows)
    assert p.count("from_json(") == 1
    assert "PythonUDF" not in p and "BatchEvalPython" not in p
