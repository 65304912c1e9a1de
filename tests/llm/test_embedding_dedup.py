import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from heartwood.llm import embedding_dedup
from heartwood.llm.embedding_dedup import Graph, links_between, near_duplicates, unit

SCHEMA = "vec_id long, embedding array<float>, label int, node string, weight int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, g, "s", 1) for i, v, g in rows], SCHEMA)


def brute(rows, least):
    n = len(rows)
    good = []
    for i, v, g in rows:
        fine = v and g is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)
        good.append(np.array(v, np.float32).astype(float) if fine else None)
    label = list(range(n))
    links = [0] * n

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(n):
        for j in range(i):
            a, b = good[i], good[j]
            if a is None or b is None or rows[i][2] != rows[j][2] or len(a) != len(b):
                continue
            if (a * b).sum() / (np.linalg.norm(a) * np.linalg.norm(b)) >= least:
                links[i] += 1
                links[j] += 1
                label[root(i)] = root(j)
    smallest = {}
    for i, (key, *_) in enumerate(rows):
        if key is not None:
            smallest[root(i)] = min(smallest.get(root(i), key), key)
    return sorted(
        str((k, links[i], smallest.get(root(i)), k == smallest.get(root(i))))
        for i, (k, *_) in enumerate(rows)
    )


def run(spark, rows, least=0.98):
    return sorted(str(tuple(r)) for r in near_duplicates(frame(spark, rows).repartition(3), least).collect())


def grouped(n, d, seed):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(20, d))
    out = []
    for i in range(n):
        c = int(r.integers(0, 20))
        x = centres[c] + (r.normal(size=d) * 0.1 if r.random() < 0.6 else r.normal(size=d))
        out.append((i, (x * r.uniform(0.1, 9)).tolist(), c % 3))
    return out


def test_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "SHARD", 60)
    rows = grouped(500, 16, 1)
    rows += [(500 + i, rows[3][1], rows[3][2]) for i in range(40)]
    got = run(spark, rows)
    assert got == brute(rows, 0.98)


def test_odd_rows(spark):
    rows = [
        (5, [1.0, 0.0], 1), (3, [2.0, 0.0], 1), (4, [1.0, 0.0], 2), (9, [1.0, 0.0], None),
        (8, [1.0, 0.0], None), (7, None, 1), (6, [0.0, 0.0], 1), (10, [float("nan"), 1.0], 1),
        (11, [None, 1.0], 1), (12, [float("inf"), 1.0], 1), (None, [1.0, 0.0], 1),
        (13, [1.0, 0.0, 0.0], 1), (3, [0.0, 1.0], 1), (14, [], 1), (15, [1e30, 0.0], 1),
    ]
    assert run(spark, rows) == brute(rows, 0.98)
    assert near_duplicates(frame(spark, [])).count() == 0


def test_walks_find_links_and_audits_widen():
    r = np.random.default_rng(5)
    centres = unit(r.normal(size=(30, 32)))
    x = unit(centres[r.integers(0, 30, 900)] + 0.015 * r.normal(size=(900, 32)))
    graph = Graph(x)
    assert all((links >= -1).all() for links in graph.links)
    truth = np.argwhere(x @ x.T >= 0.98)
    q, node = links_between(graph, x, 0.98)
    assert set(zip(q, node)) == set(map(tuple, truth))
    lonely = unit(r.normal(size=(50, 32)))
    q, node = links_between(graph, lonely, 0.98)
    assert len(q) == (lonely @ x.T >= 0.98).sum()


def test_nearest_walk():
    x = unit(np.random.default_rng(6).normal(size=(800, 16)))
    graph = Graph(x)
    q = unit(np.random.default_rng(7).normal(size=(60, 16)))
    nodes, _ = graph.walk(0, q, graph.descend(q), 48)
    best = (q @ x.T).argmax(axis=1)
    assert (nodes[:, 0] == best).mean() > 0.9


def rare_links(seed=8, n=1500, links=6):
    """Two shards of unrelated vectors, a few of which have a near copy in the other one."""
    r = np.random.default_rng(seed)
    x, y = unit(r.normal(size=(n, 24))), unit(r.normal(size=(n, 24)))
    at, to = r.choice(n, links, False), r.choice(n, links, False)
    y[to] = unit(x[at] + 0.03 * unit(r.normal(size=(links, 24))))
    return x, y, set(zip(to.tolist(), at.tolist()))


def test_rare_links_are_all_found():
    x, y, planted = rare_links()
    graph = Graph(x)
    for links in graph.links:  # walks end where they begin: only a scan finds anything
        links[:] = -1
    q, node = links_between(graph, y, 0.98)
    assert set(zip(q.tolist(), node.tolist())) == planted
    q, node = links_between(graph, x, 0.98, same=True)
    assert set(zip(q.tolist(), node.tolist())) == {(i, i) for i in range(len(x))}


def test_nodes_without_in_links_are_reached():
    # a hub near everything prunes the links to what lies around it
    r = np.random.default_rng(9)
    x = unit(np.concatenate([r.normal(size=(900, 64)), 1 + 0.3 * r.normal(size=(600, 64))]))
    for neighbours in (2, 12):
        graph = Graph(x, neighbours)
        assert graph.reached().all()


def test_classes_that_agree_in_one_hash_stay_apart(spark):
    rows = grouped(60, 8, 4) + [(60, [1.0] * 8, None)]
    named = frame(spark, rows).select(
        "vec_id",
        F.col("embedding").alias("vector"),
        "label",
        F.when(F.col("label").isNotNull(), F.lit(7).cast("long")).alias("name"),
        F.when(F.col("label").isNotNull(), F.xxhash64("label", "embedding")).alias("check"),
    )
    found = embedding_dedup._from_names(named, 0.98).collect()
    assert sorted(str(tuple(r)) for r in found) == brute(rows, 0.98)


def test_doubles_keep_their_precision(spark):
    one, turned = [1.0, 0.0], [1.0, 1e-4]
    docs = spark.createDataFrame(
        [(1, one, 1), (2, turned, 1), (3, [1.0, 1e-9], 1)],
        "vec_id long, embedding array<double>, label int",
    )
    least = 1 - 1e-10  # 1 and 3 link, 2 is 5e-9 away
    assert sorted(tuple(r) for r in near_duplicates(docs, least).collect()) == [
        (1, 1, 1, True), (2, 0, 2, True), (3, 1, 1, False)
    ]


def test_links_between_cells(spark, monkeypatch):
    # cells far smaller than what links, so most links cross them, often both ways
    monkeypatch.setattr(embedding_dedup, "SHARD", 12)
    r = np.random.default_rng(14)
    rows = [(i, v.tolist(), i % 2) for i, v in enumerate(r.normal(size=(300, 3)))]
    rows += [(300 + i, rows[7][1], rows[7][2]) for i in range(20)]
    assert run(spark, rows) == brute(rows, 0.98)


def test_linked_classes_meet_and_others_seldom():
    r = np.random.default_rng(15)
    x = r.normal(size=(4000, 64))
    x[:400] = x[400:800] + 0.14 / np.sqrt(64) * np.abs(x[400:800]) * r.normal(size=(400, 64))
    x[1000:1300] = x[1000] + 0.08 * r.normal(size=(300, 64))
    order = r.permutation(len(x))
    x = x[order]
    vectors = [pa.array(list(v), pa.list_(pa.float64())) for v in (x, x[:40])]
    classes = pa.table(
        {"node": np.arange(len(x)), "vector": vectors[0], "total": [len(x)] * len(x), "block": [0] * len(x)}
    )
    pivots = pa.table({"node": np.arange(40), "vector": vectors[1]})
    out = embedding_dedup._settle(0.98)(classes, pivots)
    cell, sees = out.column("cell").to_pylist(), [set(v) for v in out.column("sees").to_pylist()]
    links = np.argwhere(unit(x) @ unit(x).T >= 0.98)
    assert len(links) > 50_000
    assert all(cell[i] == cell[j] or cell[i] in sees[j] or cell[j] in sees[i] for i, j in links)
    sizes = np.bincount(cell, minlength=40)
    looked = (sizes**2).sum() / 2 + sum(sizes[list(v)].sum() for v in sees)
    assert looked < 0.5 * len(x) ** 2 / 2


def test_dense_groups_do_not_widen_all_beams(monkeypatch):
    r = np.random.default_rng(16)
    x = unit(r.normal(size=(1500, 64)))
    x[:150] = unit(x[0] + 0.01 * r.normal(size=(150, 64)))
    x = x[r.permutation(len(x))]
    graph, widths, walk = Graph(x), [], Graph.walk

    def counted(self, level, queries, beam, width):
        widths.append(width)
        return walk(self, level, queries, beam, width)

    monkeypatch.setattr(Graph, "walk", counted)
    q, node = links_between(graph, x, 0.98, same=True)
    assert set(zip(q, node)) == set(map(tuple, np.argwhere(x @ x.T >= 0.98)))
    assert max(widths) < len(x) / 8
