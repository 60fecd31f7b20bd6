"""Every registered query against its DuckDB oracle (row count, columns, values)."""

import os

import pytest

from oracle_harness import compare, duck

SF = os.environ.get("HACKNEY_TEST_SF", "/root/testdata/sf0.001")


def _names():
    from hackney.plans.catalog import REGISTRY
    return sorted(REGISTRY)


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, name, SF, con)
    assert r.get("match"), r


def test_contract(spark):
    import __spark_entry__ as e
    assert set(_names()) <= set(e.oracle_sql()) <= set(e.queries())
    df = e.entry(spark)
    assert df.columns == ["window_start", "window_end", "grid_id", "pickups"]
    assert df.count() > 0
