"""Every registered query against its SQL in DuckDB, on the smallest table folder."""

import os
import sys

import pytest

import __spark_entry__ as contract

sys.path.insert(0, os.path.join(os.path.dirname(contract.__file__), "tools"))
from compare import TABLES, compare  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no table folder")


@pytest.fixture(scope="module")
def db():
    import duckdb

    connection = duckdb.connect()
    for t in TABLES:
        connection.sql(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query_equals_its_sql(spark, db, name):
    good, text = compare(spark, db, name, contract.queries()[name], contract.oracle_sql().get(name), FOLDER)
    assert good, text


def test_every_sql_has_its_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
