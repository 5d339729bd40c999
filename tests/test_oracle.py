"""Every registered query against its DuckDB oracle at sf0.001 (row count, columns, values)."""

import pytest

import __spark_entry__ as E
from oracle_compare import compare, duck

SF = "/root/testdata/sf0.001"
NAMES = sorted(E.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, E.queries()[name], E.oracle_sql().get(name), SF)
    assert r["status"] in ("ok", "rows-only"), r["status"]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and df.columns == ["query_id", "rank", "book_id", "similarity", "title"]
