"""Every registered query against its SQL on DuckDB."""

import os

import pytest
from parity import compare, connect

import __spark_entry__ as entry

SF_DIR = os.environ.get("PARITY_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_its_sql():
    assert set(entry._QUERIES) == set(entry._SQL)


@pytest.mark.parametrize("name", sorted(entry._QUERIES))
def test_same_rows_as_sql(spark, con, name):
    rows = compare(spark, con, entry.queries()[name], entry.oracle_sql()[name], SF_DIR)
    assert isinstance(rows, int), rows
    assert rows > 0


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "session_id" and df.count() > 0
