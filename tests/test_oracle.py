"""Every registered query against its DuckDB oracle on the sf0.001 tables
(the driver runs the same comparison at sf0.01)."""

import os

import pytest

from feedlake.plans.registry import ORACLE, QUERIES, load_all

from .conftest import SF_SMALL
from .oracle_compare import compare, duck

load_all()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="driver tables not present")
@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, con, key):
    ok, msg = compare(spark, SF_SMALL, key, con)
    assert ok, msg


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry_contract(spark):
    import importlib.util

    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "__spark_entry__.py")
    spec = importlib.util.spec_from_file_location("spark_entry", path)
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    df = mod.entry(spark)
    assert df.columns == ["month", "revenue", "n_lines"] and df.count() > 0
    assert set(mod.oracle_sql()) <= set(mod.queries())
