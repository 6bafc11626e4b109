"""Every registered query against its DuckDB oracle (the driver's check),
at sf0.001."""

import pytest

import __spark_entry__ as E
from conftest import SF0001
from oracle_check import compare, duck

from tidemark.plans.queries import QUERIES

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF0001)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(spark, SF0001, name, E.queries()[name], E.oracle_sql().get(name), con)
    assert ok, msg


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "is_current" in df.columns
