"""Every registered query against its SQL twin on the small tables."""

import os

import duckdb
import pytest

from __spark_entry__ import entry
from rivulet.plans.registry import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def comparable(columns, rows):
    """Column order and row order do not count."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def value(v):
        return round(v, 9) if isinstance(v, float) else v

    return sorted(columns), sorted((tuple(value(r[i]) for i in order) for r in rows), key=repr)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    expected = duck.execute(ORACLES[name])
    want = comparable([d[0] for d in expected.description], expected.fetchall())
    got = comparable(result.columns, [tuple(r) for r in result.collect()])
    assert got == want
    assert got[1]
