"""Every registered query against its SQL, run by DuckDB on the same files."""

import glob
import math
import os
from datetime import date, datetime

import duckdb
import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
QUERIES = {n: q for n, q in entry.queries().items() if n in entry.QUERIES or n.startswith(("check_", "sql_"))}
ORACLES = {n: sql for n, sql in entry.oracle_sql().items() if n in QUERIES}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"create view {name} as select * from '{path}'")
    yield connection
    connection.close()


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, datetime):
        return value.isoformat()
    if isinstance(value, date):
        return datetime(value.year, value.month, value.day).isoformat()
    return float(value) if isinstance(value, int) and not isinstance(value, bool) else value


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES) and len(QUERIES) >= 80


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_oracle(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    cursor = duck.execute(ORACLES[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    expected = [tuple(plain(row[columns.index(c)]) for c in df.columns) for row in cursor.fetchall()]
    found = [tuple(plain(v) for v in row) for row in df.collect()]
    assert sorted(found, key=repr) == sorted(expected, key=repr)
