"""The queries with a SQL counterpart against DuckDB on the test tables."""

import math
from pathlib import Path

import pytest

from heartwood.llm.queries import ORACLES, QUERIES

DIRECTORY = Path("/root/testdata/sf0.001")
duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not DIRECTORY.exists(), reason="test tables not present")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for path in DIRECTORY.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    yield connection
    connection.close()


def plain(value):
    return "nan" if isinstance(value, float) and math.isnan(value) else value


@pytest.mark.parametrize("name", ORACLES)
def test_equals_sql(spark, database, name):
    df = QUERIES[name](spark, str(DIRECTORY))
    result = database.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    order = [columns.index(c) for c in df.columns]
    expected = sorted(repr(tuple(plain(r[i]) for i in order)) for r in result.fetchall())
    assert sorted(repr(tuple(map(plain, r))) for r in df.collect()) == expected
