"""Every registered query against its expected SQL in DuckDB."""

import comparison
import pytest

import __spark_entry__ as registry
from catalogue import oracles, queries

FOLDER = "/root/testdata/sf0.001"
QUERIES = queries.queries()
ORACLES = oracles.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return comparison.duck(FOLDER)


def test_every_query_has_expected_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(registry.queries())
    assert set(ORACLES) <= set(registry.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, connection, name):
    found = comparison.differences(QUERIES[name](spark, FOLDER), connection, ORACLES[name])
    assert found is None


def test_entry_has_rows(spark):
    assert registry.entry(spark).count() == 10
