"""Every registered query against its SQL, on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as contract

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in os.listdir(FOLDER):
        table = name.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{name}'")
    return connection


def canonical(table):
    names = sorted(table.column_names)
    return names, sorted(repr(tuple(row[n] for n in names)) for row in table.to_pylist())


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query(spark, duck, name):
    got = contract.queries()[name](spark, FOLDER).toArrow()
    sql = contract.oracle_sql().get(name)
    if sql is None:
        assert got.num_rows > 0
    else:
        assert canonical(got) == canonical(duck.sql(sql).to_arrow_table())


def test_every_sql_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
