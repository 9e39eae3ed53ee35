"""Every registered query against its SQL on the small tables."""

import os
from pathlib import Path

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as driver
from haulier.workloads import QUERIES as WORKLOADS

FOLDER = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
NAMES = set(WORKLOADS)
QUERIES = {name: query for name, query in driver.queries().items() if name in NAMES}
ORACLES = {name: sql for name, sql in driver.oracle_sql().items() if name in NAMES}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(FOLDER).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def plain(value):
    if value is None or value is pd.NaT or (isinstance(value, float) and value != value):
        return "NULL"
    if hasattr(value, "isoformat"):
        return pd.Timestamp(value).isoformat()
    if hasattr(value, "item"):
        value = value.item()
    return repr(float(value)) if isinstance(value, float) else str(value)


def rows(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(plain(r[i]) for i in order) for r in records)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES) == NAMES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    frame = QUERIES[name](spark, FOLDER)
    got = rows(frame.columns, [tuple(r) for r in frame.collect()])
    cursor = duck.execute(ORACLES[name])
    want = rows([d[0] for d in cursor.description], cursor.fetchall())
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1]) > 0
    assert got[1] == want[1]


def test_entry(spark):
    assert driver.entry(spark).count() == 7
