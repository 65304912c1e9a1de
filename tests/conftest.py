import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from heartwood.session import build_session  # noqa: E402
from heartwood.sources import schemas  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "heartwood-tests",
        master="local[4]",
        settings={
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


class Frames:
    """Literal frames: values are given as text or numbers and cast to the schema."""

    def __init__(self, spark):
        self.spark = spark

    def of(self, schema: str, *rows):
        return self.spark.createDataFrame(list(rows), schema)

    def table(self, name: str, *rows: dict):
        schema = {**schemas.RAW_SCHEMAS, **schemas.RESULT_SCHEMAS}[name]
        texts = [
            tuple(None if row.get(c) is None else str(row[c]) for c in schema) for row in rows
        ]
        raw = self.spark.createDataFrame(texts, ", ".join(f"{c} string" for c in schema))
        return raw.selectExpr(*[f"cast({c} as {kind}) as {c}" for c, kind in schema.items()])


@pytest.fixture(scope="session")
def frames(spark):
    return Frames(spark)


def as_dict(df, key, value):
    return {row[key]: row[value] for row in df.collect()}
