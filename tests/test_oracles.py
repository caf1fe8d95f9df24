"""Every registered query against its DuckDB oracle on the smallest tables."""

import pytest

import __spark_entry__ as E
from quayside.plans import registry
from quayside.testing import compare, duck_connect

registry.load_all()
QUERIES = registry.QUERIES
ORACLES = registry.ORACLES


@pytest.fixture(scope="module")
def con(small_dir):
    return duck_connect(small_dir)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, small_dir, con, name):
    r = compare(QUERIES[name](spark, small_dir), ORACLES[name], small_dir, con)
    assert r["values_match"], r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["asin", "is_new", "sales_estimate_data_synced_at"]
    assert 0 < df.count() <= 100
