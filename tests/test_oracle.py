"""Every registered query against its SQL in DuckDB, on the driver's tables."""

import math
import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
TABLES = [p.stem for p in Path(SF_DIR).glob("*.parquet")]


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    yield connection
    connection.close()


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "NULL"
    return repr(float(value)) if isinstance(value, float) else str(value)


def as_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


def test_every_query_has_an_oracle():
    assert contract._QUERIES.keys() <= contract.oracle_sql().keys() <= contract.queries().keys()


@pytest.mark.skipif(not TABLES, reason="no driver tables here")
@pytest.mark.parametrize("name", list(contract.oracle_sql()))
def test_query_equals_oracle(spark, duck, name):
    ours = contract.queries()[name](spark, SF_DIR)
    theirs = duck.execute(contract.oracle_sql()[name])
    columns = [c[0] for c in theirs.description]
    assert sorted(ours.columns) == sorted(columns)
    expected = as_rows(columns, theirs.fetchall())
    assert expected
    assert as_rows(ours.columns, ours.collect()) == expected
