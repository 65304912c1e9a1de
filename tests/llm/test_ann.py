import numpy as np
import pytest
from pyspark.sql import functions as F

from heartwood.llm import ann
from heartwood.llm.ann import nearest_neighbours, rotated, signed_axes

SCHEMA = "vec_id long, embedding array<float>, size string, ids int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "s", 1) for i, v in rows], SCHEMA)


def brute(rows, ask, k):
    good = [
        (i, np.array(v, np.float32).astype(float)) for i, v in rows
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
    ]
    out = {}
    for i, v in good:
        if ask(i):
            near = {}
            for j, w in good:
                if j != i and len(w) == len(v):
                    s = float(np.sqrt(((v - w) ** 2).sum()))
                    near[j] = min(s, near.get(j, s))
            out[i] = sorted((s, j) for j, s in near.items())[:k]
    return out


def run(spark, rows, every, k=10, **options):
    got = nearest_neighbours(
        frame(spark, rows).repartition(3), F.col("vec_id") % every == 0, k, **options
    ).collect()
    out = {}
    for r in sorted(got, key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.score, r.vec_id))
        assert r["rank"] == len(out[r.query_id])
    return out


def clustered(n, d, seed):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(max(n // 12, 1), d))
    x = centres[r.integers(0, len(centres), n)] + 0.5 * r.normal(size=(n, d))
    return [(i, row.tolist()) for i, row in enumerate(x * r.uniform(0.5, 2, (n, 1)))]


def test_recall_against_brute_force(spark):
    rows = clustered(1500, 24, 1)
    expected, got = brute(rows, lambda i: i % 20 == 0, 10), run(spark, rows, 20)
    assert set(got) == set(expected)
    hits = sum(len({j for _, j in got[i]} & {j for _, j in expected[i]}) for i in expected)
    assert hits / (10 * len(expected)) >= 0.9
    scores = {(i, j): s for i, near in brute(rows, lambda i: i % 20 == 0, 10**6).items()
              for s, j in near}
    assert all(abs(scores[i, j] - s) < 1e-12 for i, near in got.items() for s, j in near)


def test_small_tables_give_every_row(spark):
    odd = [
        (0, [1.0, 2.0, 3.0]), (2, [3.0, 2.0, 1.0]), (4, [1.0, 2.0, 3.0]), (6, [-1.0, 0.0, 1e-30]),
        (8, None), (10, []), (12, [0.0, 0.0, 0.0]), (14, [1.0, None, 2.0]), (None, [1.0, 1.0, 1.0]),
        (16, [1.0, float("nan"), 2.0]), (18, [float("inf"), 0.0, 0.0]), (20, [1.0, 2.0]),
        (22, [5.0, 5.0, 5.0]), (22, [5.0, 5.0, 5.0]),
    ]
    expected = {i: near for i, near in brute(odd, lambda i: True, 10).items() if near}
    assert run(spark, odd, 1) == expected


def test_a_very_common_vector_and_split_buckets(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 40)
    monkeypatch.setattr(ann, "QUERY_BLOCK", 5)
    rows = clustered(300, 8, 2) + [(i, [1.0] * 8) for i in range(300, 500)]
    got, expected = run(spark, rows, 10), brute(rows, lambda i: i % 10 == 0, 10)
    for i in range(300, 500, 10):
        assert got[i] == expected[i]
    assert set(got) == set(expected)


def test_empty_table(spark):
    assert nearest_neighbours(frame(spark, []), F.col("vec_id") % 2 == 0).count() == 0


@pytest.mark.parametrize("d", [1, 5, 64])
def test_rotations_keep_lengths_and_axes_are_the_nearest(d):
    x = np.random.default_rng(d).normal(size=(7, d))
    y = rotated(x, 3)
    assert np.allclose(np.linalg.norm(y, axis=1), 1)
    first = signed_axes(x, 3, 1)[:, 0]
    best = np.abs(y).argmax(axis=1)
    assert (first % y.shape[1] == best).all()


def test_repeats_of_one_id_take_no_places(spark):
    rows = [(5, [1.0, 0.5])] * 12 + [(7, [1.0, 0.5]), (9, [1.0, 0.5]), (100, [1.0, 0.25])]
    found = nearest_neighbours(frame(spark, rows), F.col("vec_id") == 100, k=10).collect()
    assert [(r["rank"], r.vec_id) for r in sorted(found)] == [(1, 5), (2, 7), (3, 9)]


def test_doubles_keep_their_precision(spark):
    rows = [(1, [1.0, 0.0]), (2, [1.0, 1e-9]), (3, [1.0, 3e-9])]
    wide = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = nearest_neighbours(wide, F.col("vec_id") == 1).collect()
    assert [(r.vec_id, r.score) for r in sorted(found)] == [(2, 1e-9), (3, 3e-9)]
