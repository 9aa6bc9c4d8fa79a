"""Every query with SQL gives the same columns and rows as DuckDB."""

import pytest

import __spark_entry__ as entry
from tests.compare import compare, connect

SF = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, connection, name):
    assert compare(spark, connection, entry.queries()[name], SQL[name], SF) is None


def test_entry_runs(spark):
    assert entry.entry(spark).count() == 10


def test_every_query_without_sql_is_a_trained_model():
    from floorlens.plans.trained import TRAINED

    assert set(entry.queries()) - set(SQL) - set(entry.OPTIONAL) <= set(TRAINED)
    assert set(SQL) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_no_comparison_is_empty(name):
    assert connect("/root/testdata/sf0.01").execute(SQL[name]).fetchone() is not None
