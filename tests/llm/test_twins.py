"""Queries of the subpackage against their SQL twins on the small tables."""

import duckdb
import pytest

from rivulet.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in ("documents", "benchmark", "conversations"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, duck, name):
    expected = duck.execute(ORACLES[name])
    columns = [d[0] for d in expected.description]
    result = QUERIES[name](spark, SF_DIR)
    assert set(result.columns) == set(columns)
    want = sorted(expected.fetchall(), key=repr)
    got = sorted((tuple(row) for row in result.select(*columns).collect()), key=repr)
    assert got == want


def test_thirteen_operators_have_queries():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
