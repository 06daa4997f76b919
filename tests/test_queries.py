"""Every registered query against its SQL on the smallest data folder."""

from __future__ import annotations

import os

import duckdb
import pytest

from __spark_entry__ import entry
from tierloom.sources.tables import STAR_TABLES
from tools.compare import rows_of
from workload import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in STAR_TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_flagship(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    cursor = duck.execute(ORACLES[name])
    columns = [column[0] for column in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, cursor.fetchall())
