"""Registered queries against their SQL on the smallest test tables."""

import duckdb
import pytest

import __spark_entry__ as contract
from checks.compare import _rows, tables
from star_marts.llm import queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return tables(SF_DIR)


@pytest.mark.parametrize("name", list(queries.ORACLE_SQL))
def test_matches_sql(spark, db, name):
    df = queries.QUERIES[name](spark, SF_DIR)
    result = db.execute(queries.ORACLE_SQL[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == sorted(df.columns)
    assert _rows(df.columns, df.collect()) == _rows(names, result.fetchall())


def test_registered():
    assert [n.split("_")[0] for n in queries.QUERIES] == [f"op{i}" for i in range(1, 14)]
    assert {*queries.QUERIES, "pipeline"} <= set(contract.queries())
    assert duckdb.__version__
