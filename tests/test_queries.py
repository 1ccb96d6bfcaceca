"""Every registered query against its DuckDB oracle on the smallest data."""

import pytest

import __spark_entry__ as entry_module
from compare import compare, duck

from revgraph.plans import catalog

SF = "/root/testdata/sf0.001"
QUERIES = catalog.QUERIES
SQL = {k: v for k, v in entry_module.oracle_sql().items() if k in QUERIES}


def test_registry_complete():
    assert set(SQL) == set(QUERIES)


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.columns == ["src", "dst", "year", "weight"]
    assert df.count() == len(duck(SF, SQL["link_edges"])) > 500


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, name):
    ok, msg = compare(spark, name, QUERIES[name], SQL[name], SF)
    assert ok, msg
