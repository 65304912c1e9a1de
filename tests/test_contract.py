"""Every registered query against its SQL counterpart in DuckDB on the test tables."""

import math
from decimal import Decimal
from pathlib import Path

import pytest

from contract.oracle import registered_oracles
from contract.registered import registered_queries

DIRECTORY = Path("/root/testdata/sf0.001")
QUERIES, ORACLES = registered_queries(), registered_oracles()

duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not DIRECTORY.exists(), reason="test tables not present")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for path in DIRECTORY.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    yield connection
    connection.close()


def _plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def _canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(plain, key=repr)


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, database, name):
    df = QUERIES[name](spark, str(DIRECTORY))
    result = database.execute(ORACLES[name])
    columns = [column[0] for column in result.description]
    assert _canonical(df.columns, df.collect()) == _canonical(columns, result.fetchall())
