"""Every sample query returns what its SQL returns on DuckDB."""

import datetime
import math
import sys

import duckdb
import pytest

from conftest import ROOT, SF

sys.path.insert(0, ROOT)
import __spark_entry__ as contract  # noqa: E402
from samples.derived import SAMPLE_TABLES  # noqa: E402

NAMES = sorted(contract.queries())


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in SAMPLE_TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    return connection


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6) + 0.0
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, duck, name):
    df = contract.queries()[name](spark, SF)
    found = canonical(df.columns, df.collect())
    assert found, "a query without rows shows nothing"
    if name not in contract.oracle_sql():
        return
    result = duck.execute(contract.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert found == canonical(columns, result.fetchall())


def test_entry(spark):
    rows = contract.entry(spark).collect()
    assert {r.status for r in rows} == {"SUCCESS", "FAILED"}
