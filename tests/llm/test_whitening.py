import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from heartwood.llm.whitening import Spectrum, inertia, whiten

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute_force(rows, components=16):
    """(vec_id, component) -> values, by numpy's eigensolver and Python integers."""
    kept = [
        (key, [math.floor(64 * float(c)) + 1_000_000 for c in v])
        for key, v in rows
        if v is not None and all(c is not None and math.isfinite(c) for c in v)
    ]
    fit = np.array(sorted({tuple(x) for _, x in kept}), float)
    n, sums = len(fit), fit.sum(0)
    centred = fit - sums / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:components]
    out = []
    for key, x in kept:
        deviation = sum((n * a - int(s)) ** 2 for a, s in zip(x, sums))
        for k, e in enumerate(order):
            whitened = (np.array(x) - sums / n) @ vectors[:, e] / np.sqrt(values[e])
            out.append((key, k + 1, n, deviation, whitened, values[e] / values.sum()))
    return out


def signs_aligned(found, wanted):
    """Per component, whether all values agree for one sign."""
    by = {}
    for (_, k, _, _, a, _), (_, _, _, _, b, _) in zip(found, wanted):
        by.setdefault(k, []).append((a, b))
    for pairs in by.values():
        a, b = np.array(pairs).T
        assert np.allclose(a, b, atol=1e-8) or np.allclose(a, -b, atol=1e-8)


def vectors(n, d, seed):
    dice = np.random.default_rng(seed)
    mixed = dice.standard_normal((n, d)) @ dice.standard_normal((d, d)) * 0.3
    return [[float(np.float32(c)) for c in v] for v in mixed]


def test_equals_brute_force_with_odd_rows(spark):
    good = vectors(300, 20, 1)
    rows = list(enumerate(good))
    rows += [(1000 + k, good[0]) for k in range(50)] + [(7, good[7])]  # copies, and a row twice
    rows += [(2000, None), (2001, [None, *good[0][1:]]), (2002, [float("nan"), *good[0][1:]])]
    rows += [(2003, [float("inf"), *good[0][1:]]), (None, good[3])]
    data = [(k, v, 0) for k, v in rows]
    df = spark.createDataFrame(data, SCHEMA).withColumn("component", F.lit("x"))
    key = lambda r: (r[0] is None, r[0], r[1])
    found = sorted((tuple(r)[:6] for r in whiten(df).collect()), key=key)
    wanted = sorted(brute_force(rows), key=key)
    assert len(found) == len(wanted) == 16 * 352
    assert [f[:4] for f in found] == [w[:4] for w in wanted]
    assert np.allclose([f[5] for f in found], [w[5] for w in wanted], rtol=1e-10)
    signs_aligned(found, wanted)
    assert {r.identity_error < 1e-10 for r in whiten(df).collect()} == {True}


def test_few_dimensions_and_no_spread(spark):
    rows = [(k, v, 0) for k, v in enumerate(vectors(40, 3, 2))]
    found = whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.component for r in found} == {1, 2, 3} and len(found) == 120
    one = [(k, [0.5, 0.25], 0) for k in range(9)]
    assert whiten(spark.createDataFrame(one, SCHEMA)).count() == 0
    assert whiten(spark.createDataFrame([], SCHEMA)).count() == 0
    assert whiten(spark.createDataFrame([(1, [], 0), (2, None, 0)], SCHEMA)).count() == 0


def test_other_lengths_and_wide_entries(spark):
    rows = [(k, v, 0) for k, v in enumerate(vectors(40, 4, 3))]
    odd = [(100, [1.0, 2.0], 0), (101, [1e30] * 4, 0)]
    found = whiten(spark.createDataFrame(rows + odd, SCHEMA)).collect()
    assert {r.vec_id for r in found} == set(range(40)) and {r.n for r in found} == {40}
    far = [(200, [float(2**40)] * 4, 0), (201, [-float(2**40)] * 4, 0)]
    found = whiten(spark.createDataFrame(rows + far, SCHEMA)).where("component = 1").collect()
    assert {r.vec_id for r in found if r.deviation is None} == {200, 201} and len(found) == 42


@pytest.mark.parametrize("size", [1, 2, 7, 40])
def test_spectrum_of_hard_cases(size):
    dice = np.random.default_rng(size)
    turn, _ = np.linalg.qr(dice.standard_normal((size, size)))
    for spectrum in (
        dice.random(size), np.ones(size), np.r_[np.ones(size // 2), np.zeros(size - size // 2)],
        np.exp(-np.arange(size) / 2), 1 + 1e-13 * np.arange(size),
    ):
        v = turn @ np.diag(spectrum) @ turn.T
        found = Spectrum(v)
        values, directions = found.leading(16)
        wanted = np.sort(spectrum)[::-1][:16]
        wanted = wanted[wanted > found.noise]
        assert np.allclose(values, wanted, rtol=1e-10, atol=1e-12)
        assert np.abs(directions @ directions.T - np.eye(len(values))).max(initial=0) < 1e-12
        assert np.abs(directions @ v - values[:, None] * directions).max(initial=0) < 1e-12


def test_inertia_counts_signs():
    dice = np.random.default_rng(5)
    for _ in range(200):
        m = dice.standard_normal((dice.integers(1, 12),) * 2)
        m = np.round(m + m.T, int(dice.integers(0, 3)))
        values = np.linalg.eigvalsh(m)
        if np.abs(values).min() > 1e-9:
            assert inertia(m) == ((values > 0).sum(), 0, (values < 0).sum())
    assert inertia(np.zeros((3, 3))) == (0, 3, 0)
