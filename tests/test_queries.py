"""Every registered query against its SQL on the smallest test tables."""

import pytest

import __spark_entry__ as contract
from checks.compare import difference, tables
from checks.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return tables(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_matches_sql(spark, db, name):
    assert difference(spark, db, name, SF_DIR) is None


@pytest.mark.parametrize(
    "name",
    ["session_fact_matched", "session_fact_bridged", "orphan_sessions", "dim_station_matched", "market_demand",
     "top_stations_revenue"],
)
def test_matches_sql_without_broadcasts(spark, db, name, no_broadcast):
    assert difference(spark, db, name, SF_DIR) is None


def test_contract(spark):
    assert contract.entry(spark).count() > 0
    assert set(QUERIES) <= set(contract.oracle_sql())
    assert set(contract.oracle_sql()) <= set(contract.queries())
