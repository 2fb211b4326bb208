"""Every registered query against its SQL, on the middle tables."""

import duckdb
import pytest

import __spark_entry__ as contract

FOLDER = "/root/testdata/sf0.01"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for table in TABLES.split():
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def ordered(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def test_names():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    without = set(contract.queries()) - set(contract.oracle_sql())
    assert not {name for name in without if not name.startswith("op") and name != "pipeline"}


def test_entry(spark):
    assert contract.entry(spark).count() == 20


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query(spark, con, name):
    found = contract.queries()[name](spark, FOLDER)
    expected = con.sql(contract.oracle_sql()[name])
    assert sorted(found.columns) == sorted(expected.columns)
    assert ordered(found.columns, found.collect()) == ordered(expected.columns, expected.fetchall())
