"""Every registered query against its DuckDB twin on the smallest tables."""

import pytest

import __spark_entry__ as entry
from ledgerloom.catalog import ORACLES, QUERIES, load_all
from ledgerloom.checks import compare, duck

from conftest import SF_SMALL

load_all()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(QUERIES[name](spark, SF_SMALL), con, ORACLES[name])
    assert r["values_match"], r


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert len(df.columns) == 29 and df.count() > 0   # the 30 minus the Accounts list
