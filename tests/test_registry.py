"""Every registered query against its SQL, over the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as registry
from checks.compare import difference, oracle_connection

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    connection = oracle_connection(FOLDER)
    assert isinstance(connection, duckdb.DuckDBPyConnection)
    yield connection
    connection.close()


def test_every_query_has_its_sql():
    assert set(registry._QUERIES) == set(registry.ORACLE)


@pytest.mark.parametrize("name", list(registry._QUERIES))
def test_query_equals_sql(spark, oracle, name):
    df = registry.queries()[name](spark, FOLDER)
    rows = [tuple(row) for row in df.collect()]
    result = oracle.execute(registry.oracle_sql()[name])
    columns = [column[0] for column in result.description]
    assert difference(rows, df.columns, result.fetchall(), columns) is None


def test_entry(spark):
    df = registry.entry(spark)
    assert df.columns == ["branch_id", "branch_name", "targets"]
    assert df.count() > 0
