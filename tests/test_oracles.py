"""Every registered query with SQL, compared whole on the smallest tables."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), "..", "scripts"))

import __spark_entry__ as contract  # noqa: E402
from check_oracles import rows_of  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def connection():
    con = duckdb.connect()
    for name in os.listdir(SF_DIR):
        con.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{SF_DIR}/{name}'")
    return con


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_matches_sql(spark, connection, name):
    frame = contract.queries()[name](spark, SF_DIR)
    result = connection.execute(contract.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(frame.columns)
    assert rows_of(frame.columns, [tuple(r) for r in frame.collect()]) == rows_of(
        names, result.fetchall())


@pytest.mark.parametrize("name", sorted(set(contract.queries()) - set(contract.oracle_sql())))
def test_query_without_sql_runs(spark, name):
    assert contract.queries()[name](spark, SF_DIR).count() > 0
