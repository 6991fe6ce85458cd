"""Every registered query equals its DuckDB oracle on the smallest test data."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.oracle_harness import compare, duck

from .conftest import SF_SMALL

NAMES = sorted(oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_oracle():
    from strata.plans.catalog import QUERIES
    from strata.streaming.catalog import STREAM_QUERIES
    assert {*QUERIES, *STREAM_QUERIES} <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, name, SF_SMALL, con)
    assert r["match"], r


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() > 0
    assert "lifetime_value" in df.columns
