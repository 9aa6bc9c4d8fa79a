"""Queries with SQL: equal rows from Spark and DuckDB on the smallest tables."""

import pytest

from floorlens.llm.queries import LLM_QUERIES, LLM_SQL
from tests.compare import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(LLM_SQL))
def test_rows_equal_those_of_the_sql(spark, name):
    assert compare(spark, connect(SF), LLM_QUERIES[name], LLM_SQL[name], SF) is None
