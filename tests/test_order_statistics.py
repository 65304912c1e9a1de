"""Quantiles from the histogram, and plans that read what is stored."""

import random
from pathlib import Path

import numpy as np
import pytest

from contract.registered import registered_queries
from heartwood import session
from heartwood.operators.order_statistics import histogram, quantiles
from heartwood.sources.files import exists

DIRECTORY = Path("/root/testdata/sf0.001")
on_test_tables = pytest.mark.skipif(not DIRECTORY.exists(), reason="test tables not present")
EDGES = (0.0, 0.1, 0.25, 0.5, 0.75, 1.0)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 10, 101])
def test_quantiles_interpolate_between_ranks(spark, n):
    dice = random.Random(n)
    values = [round(dice.uniform(0, 9), dice.choice([0, 1])) for _ in range(n)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double").repartition(3)
    found = quantiles(histogram(df, "v"), EDGES).first()["quantiles"]
    assert found == pytest.approx(np.quantile(values, EDGES).tolist(), abs=1e-12)


def test_histogram(spark):
    df = spark.createDataFrame([(v,) for v in (2.5, 1.0, 2.5, None, 2.5)], "v double")
    assert sorted(map(tuple, histogram(df, "v").collect())) == [(1.0, 1, 0, 4), (2.5, 3, 1, 4)]
    nothing = df.limit(0)
    assert histogram(nothing, "v").count() == 0
    assert quantiles(histogram(nothing, "v"), EDGES).first()["quantiles"] == [None] * len(EDGES)


def test_one_value_for_a_third_of_the_rows(spark):
    df = spark.range(90_000).selectExpr("IF(id % 3 = 0, 7.0D, CAST(id AS DOUBLE)) AS v")
    want = np.quantile([7.0 if i % 3 == 0 else float(i) for i in range(90_000)], EDGES)
    found = quantiles(histogram(df, "v"), EDGES).first()["quantiles"]
    assert found == pytest.approx(want.tolist())


def relations(df):
    text = df._jdf.queryExecution().optimizedPlan().toString()
    return sum(line.lstrip(" :+-").startswith("Relation") for line in text.splitlines())


@on_test_tables
@pytest.mark.parametrize(
    "name, most", [("workload_category", 4), ("run_summary", 40), ("digest_lines", 40)]
)
def test_what_several_branches_read_is_planned_once(spark, name, most):
    assert 0 < relations(registered_queries()[name](spark, str(DIRECTORY))) <= most


def test_stored_rows_can_be_cleared(spark):
    df = session.store_once(spark.range(5).toDF("n"))
    assert sorted(r.n for r in df.collect()) == [0, 1, 2, 3, 4]
    folder = session.shared_folder(spark)
    assert exists(spark, folder)
    session.clear_stored(spark)
    assert not exists(spark, folder)
