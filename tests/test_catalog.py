"""Every registered query against the independent engine, on whole small tables."""

import datetime as dt
import re

import duckdb
import pytest

import __spark_entry__ as driver

SF_DIR = "/root/testdata/sf0.001"
TABLES = (
    "lineitem", "orders", "customer", "nation", "part", "events", "documents", "conversations",
)
QUERIES, SQL = driver.queries(), driver.oracle_sql()
TYPES = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "date": "DATE",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS FROM '{SF_DIR}/{table}.parquet'")
    return connection


def plain(value):
    return value.isoformat() if isinstance(value, dt.date) else value


def test_every_query_has_sql():
    # Queries of the training-data package are tested beside it.
    own = {name for name in QUERIES if not re.match(r"op\d+_|pipeline$", name)}
    assert own <= SQL.keys() <= QUERIES.keys()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    result = duck.execute(SQL[name])
    kinds = {column[0]: str(column[1]) for column in result.description}
    found = result.fetchall()
    names = sorted(kinds)
    assert sorted(df.columns) == names
    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema.fields} == kinds
    positions = [list(kinds).index(n) for n in names]
    expected = sorted(repr([plain(row[i]) for i in positions]) for row in found)
    actual = sorted(repr([plain(row[n]) for n in names]) for row in df.collect())
    assert actual == expected


def test_entry_has_one_row_per_temperature_bucket(spark):
    df = driver.entry(spark)
    assert df.columns == ["temp_category", "avg_sales"]
    assert {row.temp_category for row in df.collect()} <= {"Cold", "Moderate", "Hot"}
