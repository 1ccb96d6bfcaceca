"""Queries of the training-data operators that SQL can express, against DuckDB."""

import pytest
from compare import compare

from revgraph.llm.queries import QUERIES
from revgraph.llm.sql import SQL

SF = "/root/testdata/sf0.001"


def test_every_operator_has_one_query():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, name):
    ok, msg = compare(spark, name, QUERIES[name], SQL[name], SF)
    assert ok, msg
