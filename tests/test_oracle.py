"""Every query against its SQL on the same tables, computed by another engine."""

import os

import duckdb
import pytest

import __spark_entry__ as driver

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def expected():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def as_bag(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr(tuple(row[i] for i in order)) for row in rows)


@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_query(spark, expected, name):
    found = driver.queries()[name](spark, FOLDER)
    cursor = expected.execute(driver.oracle_sql()[name])
    names = [column[0] for column in cursor.description]
    rows = cursor.fetchall()
    assert sorted(found.columns) == sorted(names)
    assert rows, "the comparison would be empty"
    assert as_bag(found.collect(), found.columns) == as_bag(rows, names)
