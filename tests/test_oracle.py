"""Every query with SQL against another engine, on the given tables."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as contract  # noqa: E402
from check_queries import TABLES, normal  # noqa: E402


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as from '{small}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_same_as_sql(spark, small, duck, name):
    ours = normal(contract.queries()[name](spark, small).toPandas())
    theirs = normal(duck.sql(contract.oracle_sql()[name]).df())
    assert list(ours.columns) == list(theirs.columns)
    assert ours.equals(theirs)


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).count() == 300


@pytest.mark.parametrize("name", sorted(set(contract.queries()) - set(contract.oracle_sql())))
def test_runs(spark, small, name):
    assert contract.queries()[name](spark, small).count() > 0
