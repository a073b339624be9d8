"""Every registered query against its SQL counterpart on the smallest test data."""

import math
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as contract
from shelfwise.plans.catalog import QUERIES
from shelfwise.plans.oracle import ORACLES

FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test data not present")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def plain(value):
    if value is None or value is pd.NaT or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return str(value)
    return repr(round(float(value), 6)) if isinstance(value, (int, float)) else str(value)


def rows(frame):
    frame = frame[sorted(frame.columns)].astype(object)
    return sorted((tuple(map(plain, row)) for row in frame.itertuples(index=False)), key=str)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert QUERIES.items() <= contract.queries().items()
    assert ORACLES.items() <= contract.oracle_sql().items()


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_result(spark, duck, name):
    result = QUERIES[name](spark, FOLDER).toPandas()
    expected = duck.execute(ORACLES[name]).df()
    assert sorted(result.columns) == sorted(expected.columns)
    assert rows(result) == rows(expected)
