"""Every registered query against its SQL twin in DuckDB, on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as driver

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLES = driver.queries(), driver.oracle_sql()
# Queries of the subpackage have their tests in tests/llm.
OWN = {name for name in QUERIES if not (name == "pipeline" or name.startswith("op"))}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in ("customer", "events", "lineitem", "orders"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    yield connection
    connection.close()


def comparable(rows):
    def key(row):
        return [(value is None, str(value)) for value in row]

    def plain(value):
        if isinstance(value, float):
            return "nan" if math.isnan(value) else value + 0.0
        return value

    return sorted((tuple(map(plain, row)) for row in rows), key=key)


def test_every_query_has_a_check():
    assert set(ORACLES) >= OWN


@pytest.mark.parametrize("name", sorted(OWN))
def test_query_equals_sql(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    cursor = duck.execute(ORACLES[name])
    columns = [column[0] for column in cursor.description]
    assert sorted(result.columns) == sorted(columns)
    got = comparable(result.select(*[f"`{column}`" for column in columns]).collect())
    assert got == comparable(cursor.fetchall())


def test_entry(spark):
    flagship = driver.entry(spark)
    assert flagship.count() > 0
    assert flagship.columns[:2] == ["symbol", "trade_date"]
