"""Near-duplicate embeddings by small-world graphs per shard.

Vectors with equal contents and label are one class with a weight. The classes of a label are
dealt to cells, each to its nearest of some classes drawn as pivots, and those of a cell to shards
of bounded size. Each shard builds a hierarchical navigable small-world graph: layers of fewer and
fewer nodes, in which a search walks towards a query from the top down, and on the lowest layer
keeps a beam of the nearest nodes seen. Every shard of a cell is asked with the vectors of every
shard of it, so two shards are searched both ways. A query whose beam is full of links is compared
with the whole shard. Queries are drawn and compared with a scan of the shard until enough of them
have a link to a different vector; as long as the walks miss one of these links, all beams double,
and soon comprise the whole shard. Where links are so rare that all queries are drawn, the scan is
the answer, and it is exact.

Links between cells are found exactly. Let x have the nearest pivot p and y the nearest pivot q, all
of length 1, and |x - y| <= e, as it is where they link. Then (x.p - x.q) + (y.q - y.p) =
(x - y).(p - q) <= e |p - q|, so one of the two brackets is at most e |p - q| / 2. A class visits
each cell for which its own bracket is, and is compared there with all members.

Links are counted in the task that finds them, and only a spanning forest of them leaves it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructType

from heartwood.llm.common import components, store
from heartwood.llm.vectors import matrix, usable

#: classes of a shard, about, and of a cell where a label has fewer than ``CELLS`` of these
SHARD = 1500
#: cells of a label, at most about; classes that find their cells together, and visitors of a row
CELLS, BLOCK = 4096, 8192
#: shards and visitors that reach a Python worker at once, about
BATCH_BYTES = 16 << 20
#: neighbours of a node on a layer; on the lowest it may have twice as many
NEIGHBOURS = 12
BUILD_BEAM, FIRST_BEAM = 32, 24
#: nodes that enter the graph together, and queries that walk together
BATCH = 64
#: queries with a link to a different vector that are compared with a scan, and queries of a scan
AUDIT, SCAN = 64, 128
#: links a node may get on the lowest layer for nodes that no walk reaches
EXTRA = 8
#: a walk goes on for nodes this much below the threshold
MARGIN = 0.03


def unit(x: np.ndarray) -> np.ndarray:
    scaled = x / np.abs(x).max(axis=1, keepdims=True)  # lengths may overflow
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


class Graph:
    """A hierarchical navigable small-world graph over unit vectors."""

    def __init__(self, x: np.ndarray, neighbours: int = NEIGHBOURS):
        self.x, self.n = x, len(x)
        random = np.random.default_rng(11)
        height = np.floor(-np.log(1 - random.random(self.n)) / np.log(neighbours)).astype(int)
        self.height = np.minimum(height, 4)
        self.top = int(self.height.max(initial=0))
        self.entry = int(self.height.argmax()) if self.n else 0
        self.limits = [2 * neighbours if level == 0 else neighbours for level in range(5)]
        #: neighbours by layer, -1 where there is none
        self.links = [np.full((self.n, m), -1, np.int32) for m in self.limits[: self.top + 1]]
        self.degree = [np.zeros(self.n, np.int32) for _ in self.links]
        order = np.r_[self.entry, np.setdiff1d(np.arange(self.n), self.entry)] if self.n else []
        self.inside = np.zeros(self.n, bool)
        for first in range(0, self.n, BATCH):
            self._insert(np.asarray(order[first : first + BATCH]), neighbours)
        if self.n:
            self._reach_all()

    def walk(
        self, level: int, queries: np.ndarray, beam: np.ndarray, width: int
    ) -> tuple[np.ndarray, np.ndarray]:
        """Beams (nodes and similarities, nearest first, -1: empty) after walking a layer."""
        b = len(queries)
        seen = np.zeros((b, self.n + 1), bool)
        nodes = np.full((b, width), -1, np.int64)
        k = min(width, beam.shape[1])
        nodes[:, :k] = beam[:, :k]
        rows = np.arange(b)
        seen[rows[:, None], nodes] = True
        near = np.where(nodes >= 0, np.einsum("bd,bkd->bk", queries, self.x[nodes]), -np.inf)
        done = nodes < 0
        active = rows
        while len(active):
            open_near = np.where(done[active], -np.inf, near[active])
            pick = open_near.argmax(axis=1)
            go = open_near[np.arange(len(active)), pick] > -np.inf
            active, pick = active[go], pick[go]
            if not len(active):
                break
            done[active, pick] = True
            reach = self.links[level][nodes[active, pick]].astype(np.int64)
            fresh = (reach >= 0) & ~seen[active[:, None], reach]
            reach = np.where(fresh, reach, -1)
            seen[active[:, None], reach] = True
            got = np.full(reach.shape, -np.inf)
            at, which = np.nonzero(fresh)
            got[at, which] = np.einsum(
                "kd,kd->k", queries[active[at]], self.x[reach[at, which]]
            )
            all_nodes = np.concatenate([nodes[active], reach], axis=1)
            all_near = np.concatenate([near[active], got], axis=1)
            all_done = np.concatenate([done[active], ~fresh], axis=1)
            best = np.argsort(-all_near, axis=1, kind="stable")[:, :width]
            nodes[active] = np.take_along_axis(all_nodes, best, 1)
            near[active] = np.take_along_axis(all_near, best, 1)
            done[active] = np.take_along_axis(all_done, best, 1)
        order = np.argsort(-near, axis=1, kind="stable")
        return np.take_along_axis(nodes, order, 1), np.take_along_axis(near, order, 1)

    def descend(self, queries: np.ndarray, level: int = 0) -> np.ndarray:
        """Entry points of ``level`` for each query: the nearest found on the layers above."""
        beam = np.full((len(queries), 1), self.entry, np.int64)
        for upper in range(self.top, level, -1):
            beam, _ = self.walk(upper, queries, beam, 4)
        return beam

    def _spread(self, node: int, others: np.ndarray, near: np.ndarray, most: int) -> list[int]:
        """Of ``others`` (nearest first) those nearer to the node than to one chosen before."""
        chosen: list[int] = []
        among = self.x[others] @ self.x[others].T
        for i in range(len(others)):
            if len(chosen) == most:
                break
            if not chosen or among[i, chosen].max() < near[i]:
                chosen.append(i)
        for i in range(len(others)):  # what is left of the room goes to the nearest ones
            if len(chosen) >= max(most // 2, 1):
                break
            if i not in chosen:
                chosen.append(i)
        return others[chosen].tolist()

    def _connect(self, level: int, node: int, other: int) -> None:
        links, degree = self.links[level], self.degree[level]
        d = int(degree[node])
        if other in links[node, :d]:
            return
        if d < links.shape[1]:
            links[node, d] = other
            degree[node] += 1
            return
        all_ = np.append(links[node], other).astype(np.int64)
        near = self.x[all_] @ self.x[node]
        order = np.argsort(-near, kind="stable")
        kept = self._spread(node, all_[order], near[order], links.shape[1])
        links[node] = -1
        links[node, : len(kept)] = kept
        degree[node] = len(kept)

    def _insert(self, new: np.ndarray, neighbours: int) -> None:
        q = self.x[new]
        first = not self.inside.any()
        beam = np.full((len(new), 1), self.entry, np.int64)
        among = q @ q.T
        for level in range(self.top, -1, -1):
            here = self.height[new] >= level
            if not first:
                beam, near = self.walk(level, q, beam, BUILD_BEAM if here.any() else 4)
            for i in np.flatnonzero(here):
                peers = np.flatnonzero(here[:i])
                others, sims = new[peers], among[i, peers]
                if not first:
                    held = beam[i] >= 0
                    others = np.r_[beam[i][held], others]
                    sims = np.r_[near[i][held], sims]
                if not len(others):
                    continue
                order = np.argsort(-sims, kind="stable")[: 2 * BUILD_BEAM]
                for other in self._spread(
                    int(new[i]), others[order], sims[order], neighbours
                ):
                    self._connect(level, int(new[i]), other)
                    self._connect(level, other, int(new[i]))
        self.inside[new] = True

    def reached(self) -> np.ndarray:
        """Which nodes links of the lowest layer lead to from the entry."""
        seen = np.zeros(self.n, bool)
        self._spread_from(seen, self.entry)
        return seen

    def _spread_from(self, seen: np.ndarray, node: int) -> None:
        seen[node] = True
        edge = np.array([node])
        while len(edge):
            edge = np.unique(self.links[0][edge])
            edge = edge[edge >= 0]
            edge = edge[~seen[edge]]
            seen[edge] = True

    def _reach_all(self) -> None:
        """Give nodes that no links lead to (pruned by ``_connect``) one from the nearest node
        that is reached and has room, in columns of their own, which nothing prunes."""
        seen = self.reached()
        used = np.zeros(self.n, np.int64)
        extra = np.full((self.n, EXTRA), -1, np.int32)
        for node in np.flatnonzero(~seen):
            if seen[node]:
                continue
            near = np.where(seen & (used < EXTRA), self.x @ self.x[node], -np.inf)
            at = int(near.argmax())
            extra[at, used[at]] = node
            used[at] += 1
            self._spread_from(seen, int(node))
        if used.any():
            self.links[0] = np.concatenate([self.links[0], extra[:, : used.max()]], axis=1)

    def within(self, queries: np.ndarray, least: float, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, node) with similarity ``least`` or more that walks of a beam find; a query
        whose beam holds nothing else is compared with all nodes, for less than a wider beam."""
        out_q, out_n = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for first in range(0, len(queries), BATCH):
            part = np.arange(first, min(first + BATCH, len(queries)))
            full = np.ones(len(part), bool)
            if width < self.n:
                nodes, near = self.walk(0, queries[part], self.descend(queries[part]), width)
                full = near[:, -1] >= least - MARGIN
                at, which = np.nonzero((nodes >= 0) & (near >= least) & ~full[:, None])
                out_q.append(part[at])
                out_n.append(nodes[at, which])
            at, which = np.nonzero(queries[part[full]] @ self.x.T >= least)
            out_q.append(part[full][at])
            out_n.append(which)
        return np.concatenate(out_q), np.concatenate(out_n)


def links_between(
    graph: Graph, queries: np.ndarray, least: float, same: bool = False
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, node) with similarity ``least`` or more; ``same``: queries are the nodes.

    Queries are scanned until ``AUDIT`` of them have a link to a different vector, and beams widen
    until walks find all links of these. If all are scanned, the scan is the answer.
    """
    order = np.random.default_rng(13).permutation(len(queries))
    found_q, found_n = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    must: set[tuple[int, int]] = set()
    linked = done = 0
    while done < len(order) and linked < AUDIT:
        part = order[done : done + SCAN]
        done += len(part)
        near = queries[part] @ graph.x.T
        at, node = np.nonzero(near >= least - 1e-12)
        q = part[at]
        found_q.append(q)
        found_n.append(node)
        # a vector finds itself, which says nothing about walks
        tells = near[at, node] >= least + 1e-12
        if same:
            tells &= q != node
        must.update(zip(q[tells].tolist(), node[tells].tolist()))
        linked += len(np.unique(q[tells]))
    if done == len(order):
        return np.concatenate(found_q), np.concatenate(found_n)
    drawn, rest = order[:done], order[done:]
    width = FIRST_BEAM
    while width < graph.n:
        q, node = graph.within(queries[drawn], least - 1e-12, width)
        if must <= set(zip(drawn[q].tolist(), node.tolist())):
            break
        width = 2 * width if 16 * width < graph.n else graph.n
    # what is scanned is known in full
    q, node = graph.within(queries[rest], least - 1e-12, width)
    return np.concatenate([*found_q, rest[q]]), np.concatenate([*found_n, node])


def _forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect what all links (a, b) connect."""
    names, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = at[: len(a)], at[len(a) :]
    root = np.arange(len(names))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    first, step = 0, 1024
    while first < len(a):
        x, y = a[first : first + step], b[first : first + step]
        apart = root[x] != root[y]  # most links of a dense group connect nothing new
        for i, j in zip(x[apart].tolist(), y[apart].tolist()):
            p, q = find(i), find(j)
            if p != q:
                root[p] = q
                out.append((int(names[i]), int(names[j])))
        while (root != root[root]).any():
            root = root[root]
        first, step = first + step, max(step, len(names))
    return out


def _settle(least: float):
    """Function on some classes of a label and its pivots: each class's cell, and those it visits."""
    reach = np.sqrt(max(0.0, 2 - 2 * least))

    def run(classes: pa.Table, pivots: pa.Table) -> pa.Table:
        n = len(classes)
        cell, often, sees = np.zeros(n, np.int32), np.zeros(n + 1, np.int32), [np.zeros(0, np.int32)]
        if n and len(pivots):
            x = unit(matrix(classes.column("vector")))
            q = unit(matrix(pivots.sort_by("node").column("vector")))
            for first in range(0, n, 512):
                near = x[first : first + 512] @ q.T
                home = near.argmax(axis=1)
                gap = near[np.arange(len(near)), home][:, None] - near
                apart = np.sqrt(np.maximum(0, 2 - 2 * (q[home] @ q.T)))
                visits = gap <= reach * apart / 2 + 1e-7
                visits[np.arange(len(near)), home] = False
                cell[first : first + 512] = home
                often[1:][first : first + 512] = visits.sum(axis=1)
                sees.append(np.nonzero(visits)[1].astype(np.int32))
        out = classes.drop_columns(["total", "block"])
        out = out.append_column("cell", pa.array(cell))
        sees = pa.ListArray.from_arrays(np.cumsum(often, dtype=np.int32), np.concatenate(sees))
        return out.append_column("sees", sees)

    return run


def _build(table: pa.Table) -> pa.Table:
    """A shard as one row: its classes, weights, vectors, and the layers of its graph."""
    x = matrix(table.column("vector"))
    graph = Graph(unit(x))
    sees = pa.concat_arrays(table.column("sees").chunks)
    return pa.table(
        {
            "label": table.column("label").slice(0, 1),
            "size": table.column("size").slice(0, 1),
            "cell": table.column("cell").slice(0, 1),
            "shard": table.column("shard").slice(0, 1),
            "node": pa.array([table.column("node").to_pylist()], pa.list_(pa.int64())),
            "weight": pa.array([table.column("weight").to_pylist()], pa.list_(pa.int64())),
            "sees": pa.ListArray.from_arrays([0, len(sees)], sees),
            "vectors": pa.array([x.tobytes()], pa.binary()),
            "height": pa.array([graph.height.astype(np.int8).tobytes()], pa.binary()),
            "layers": pa.array([[a.tobytes() for a in graph.links]], pa.list_(pa.binary())),
        }
    )


def _gather(table: pa.Table) -> pa.Table:
    """Some visitors of a cell as one row, with vectors as wide as they come."""
    names = ("other_node", "other_weight", "home")
    x = table.column("vector").combine_chunks().flatten().to_numpy()
    return pa.table(
        {
            **{c: table.column(c).slice(0, 1) for c in ("label", "size", "cell", "part")},
            **{c: pa.array([table.column(c).to_pylist()], pa.list_(pa.int64())) for c in names},
            "other_vectors": pa.array([x.tobytes()], pa.binary()),
        }
    )


def _restored(x: np.ndarray, height: bytes, layers: list[bytes]) -> Graph:
    graph = Graph.__new__(Graph)
    graph.x, graph.n = x, len(x)
    graph.height = np.frombuffer(height, np.int8).astype(int)
    graph.top, graph.entry = len(layers) - 1, int(graph.height.argmax())
    graph.links = [np.frombuffer(a, np.int32).reshape(graph.n, -1) for a in layers]
    return graph


def _cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Cosines of rows in double precision."""
    return (x * y).sum(axis=1) / (np.linalg.norm(x, axis=1) * np.linalg.norm(y, axis=1))


def _counted(nodes: np.ndarray, links: np.ndarray) -> pa.RecordBatch:
    has = links > 0
    return pa.record_batch(
        {"a": nodes[has], "b": pa.nulls(int(has.sum()), pa.int64()), "links": links[has]}
    )


def _linked(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    edges = _forest(a, b)
    return pa.record_batch(
        {
            "a": pa.array([e[0] for e in edges], pa.int64()),
            "b": pa.array([e[1] for e in edges], pa.int64()),
            "links": pa.nulls(len(edges), pa.int64()),
        }
    )


def _visit(least: float):
    """Arrow function on shards and visitors of their cells: as ``_compare``, by a scan.

    Two classes that visit each other's cells meet twice; the smaller cell counts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                of = {c: batch.column(c)[row] for c in batch.schema.names}
                d, cell = of["size"].as_py(), of["cell"].as_py()
                nodes, weights = (of[c].values.to_numpy() for c in ("node", "weight"))
                others, loads = (of[c].values.to_numpy() for c in ("other_node", "other_weight"))
                x = np.frombuffer(of["vectors"].as_buffer()).reshape(-1, d)
                y = of["other_vectors"].as_buffer()
                y = np.frombuffer(y, f"f{len(y) // (len(others) * d)}").astype(float).reshape(-1, d)
                home = of["home"].values.to_numpy()
                sees = of["sees"].values
                often = sees.value_lengths().to_numpy()
                seen = np.repeat(np.arange(len(x)) << 32, often) | sees.flatten().to_numpy()
                one, two = unit(x), unit(y)
                gain, back = np.zeros(len(x), np.int64), np.zeros(len(y), np.int64)
                ends = []
                for first in range(0, len(y), SCAN):
                    near = two[first : first + SCAN] @ one.T
                    q, node = np.nonzero(near >= least - 1e-12)
                    close = near[q, node] < least + 1e-12
                    q += first
                    keep = np.ones(len(q), bool)
                    keep[close] = _cosines(y[q[close]], x[node[close]]) >= least
                    both = np.isin(node << 32 | home[q], seen)
                    keep &= ~both | (cell < home[q])
                    q, node = q[keep], node[keep]
                    np.add.at(gain, node, loads[q])
                    np.add.at(back, q, weights[node])
                    ends += _forest(others[q], nodes[node])
                yield _counted(nodes, gain)
                yield _counted(others, back)
                a, b = np.array(ends, np.int64).reshape(-1, 2).T
                yield _linked(a, b)

    return run


def _compare(least: float):
    """Arrow function on pairs of shards: link counts of classes, and a forest of the links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                of = {c: batch.column(c)[row] for c in batch.schema.names}
                d = of["size"].as_py()
                x, y = (
                    np.frombuffer(of[c].as_buffer()).reshape(-1, d)
                    for c in ("vectors", "other_vectors")
                )
                nodes, weights = (of[c].values.to_numpy() for c in ("node", "weight"))
                others, loads = (of[c].values.to_numpy() for c in ("other_node", "other_weight"))
                same = of["shard"].as_py() == of["other"].as_py()
                one, two = unit(x), unit(y)
                graph = _restored(
                    one, of["height"].as_py(), [b.as_py() for b in of["layers"].values]
                )
                q, node = links_between(graph, two, least, same)
                # found either way round counts both ways, once
                if same:
                    a, b = np.minimum(q, node), np.maximum(q, node)
                    pairs = np.unique(np.stack([a, b])[:, a != b], axis=1)
                    q, node = pairs
                else:
                    graph = _restored(
                        two,
                        of["other_height"].as_py(),
                        [b.as_py() for b in of["other_layers"].values],
                    )
                    back, forth = links_between(graph, one, least)
                    q, node = np.unique(
                        np.stack([np.r_[q, forth], np.r_[node, back]]), axis=1
                    )
                keep = np.zeros(len(q), bool)
                for k in range(0, len(q), 100_000):
                    part = slice(k, k + 100_000)
                    keep[part] = _cosines(y[q[part]], x[node[part]]) >= least
                q, node = q[keep], node[keep]
                gain = np.zeros(len(x), np.int64)
                np.add.at(gain, node, loads[q])
                back = gain if same else np.zeros(len(y), np.int64)
                np.add.at(back, q, weights[node])
                counted = [(nodes, gain)] if same else [(nodes, gain), (others, back)]
                for names, more in counted:
                    yield _counted(names, more)
                yield _linked(others[q], nodes[node])

    return run


def near_duplicates(vectors: DataFrame, least: float = 0.98) -> DataFrame:
    """vec_id, n_links, component_id, kept: which rows lie near one another.

    ``vectors`` has vec_id, embedding and label. Rows link if their labels are equal and not null,
    their vectors are as long, and the cosine in double precision is ``least`` or more; vectors of
    doubles keep their precision. Vectors
    that are missing, zero, or have missing or non-finite components link with nothing. n_links
    counts other rows, so rows with one vec_id count each. component_id is the smallest vec_id
    reachable by links, its own included; a missing vec_id is never smallest. kept marks rows that
    carry it. Other columns play no role; an empty table gives an empty result.
    """
    single = vectors.schema["embedding"].dataType.simpleString() == "array<float>"
    kind = "array<float>" if single else "array<double>"
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("embedding").cast(kind).alias("vector"),
        F.col("label"),
    ).withColumn("takes_part", usable(F.col("vector")) & F.col("label").isNotNull())
    rows = rows.select(
        "vec_id",
        "vector",
        "label",
        F.when(F.col("takes_part"), F.xxhash64("label", "vector")).alias("name"),
        F.when(F.col("takes_part"), F.xxhash64(F.lit("second"), "label", "vector")).alias("check"),
    )
    return _from_names(rows, least)


def _from_names(rows: DataFrame, least: float) -> DataFrame:
    """``near_duplicates`` of rows (vec_id, vector, label) with the two hashes that name their
    class. A class's node is a number given once, when the classes are written."""
    classes = store(
        rows.where("name is not null")
        .groupBy("name", "check")
        .agg(
            F.first("label").cast("string").alias("label"),
            F.first("vector").alias("vector"),
            F.count("*").alias("weight"),
            F.min("vec_id").alias("least"),
        )
        .withColumn("size", F.size("vector"))
        .withColumn("node", F.monotonically_increasing_id())
    )
    label = ["label", "size"]
    blocks = F.ceil(F.col("total") / BLOCK)
    sized = (
        classes.join(classes.groupBy(*label).agg(F.count("*").alias("total")), label)
        .withColumn("block", F.pmod("node", blocks))
    )
    rate = F.greatest(F.lit(SHARD).cast("long"), F.ceil(F.col("total") / CELLS))
    pivots = sized.where(F.pmod("check", rate) == 0).select(
        *(F.col(c).alias(c) for c in (*label, "node", "vector")),  # columns of its own for cogroup
        F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("block"),
    )
    settled = store(
        sized.groupBy(*label, "block")
        .cogroup(pivots.groupBy(*label, "block"))
        .applyInArrow(
            _settle(least),
            StructType([*classes.schema.fields])
            .add("cell", IntegerType())
            .add("sees", ArrayType(IntegerType())),
        )
    )
    group = [*label, "cell"]
    shards = settled.groupBy(*group).agg(F.ceil(F.count("*") / SHARD).cast("int").alias("shards"))
    built = store(
        settled.join(shards, group)
        .withColumn("shard", F.pmod("check", "shards").cast("int"))
        .groupBy(*group, "shard")
        .applyInArrow(
            _build,
            "label string, size int, cell int, shard int, node array<long>, weight array<long>, "
            "sees array<array<int>>, vectors binary, height binary, layers array<binary>",
        )
    )
    # every two shards of a cell, by number first; their contents are joined by shard
    numbers = built.select(*group, "shard")
    pairs = numbers.join(numbers.withColumnRenamed("shard", "other"), group).where("shard <= other")
    other = built.select(
        *group,
        F.col("shard").alias("other"),
        F.col("node").alias("other_node"),
        F.col("weight").alias("other_weight"),
        F.col("vectors").alias("other_vectors"),
        F.col("height").alias("other_height"),
        F.col("layers").alias("other_layers"),
    )
    found = store(
        pairs.join(built, [*group, "shard"])
        .join(other, [*group, "other"])
        .mapInArrow(_compare(least), "a long, b long, links long"),
        BATCH_BYTES,
    )
    visits = settled.select(
        *label,
        F.explode("sees").alias("cell"),
        F.col("cell").cast("long").alias("home"),
        F.col("node").alias("other_node"),
        F.col("weight").alias("other_weight"),
        "vector",
    )
    parts = visits.groupBy(*group).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts"))
    visitors = store(
        visits.join(parts, group)
        .withColumn("part", F.pmod(F.xxhash64("other_node"), "parts").cast("int"))
        .groupBy(*group, "part")
        .applyInArrow(
            _gather,
            "label string, size int, cell int, part int, other_node array<long>, "
            "other_weight array<long>, home array<long>, other_vectors binary",
        )
    )
    crossed = store(
        numbers.join(visitors.select(*group, "part"), group)
        .join(built.drop("height", "layers"), [*group, "shard"])
        .join(visitors, [*group, "part"])
        .mapInArrow(_visit(least), "a long, b long, links long"),
        BATCH_BYTES,
    )
    found = found.union(crossed)
    counts = found.where("b is null").groupBy(F.col("a").alias("node")).agg(
        F.sum("links").alias("links")
    )
    linked = components(found.where("b is not null").select("a", "b"))
    named = (
        classes.select("node", "name", "check", "least", "weight")
        .join(linked, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
    )
    smallest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    known = (
        named.join(smallest, "component")
        .join(counts, "node", "left")
        .select(
            "name",
            "check",
            "component_id",
            (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
        )
    )
    component = F.when(F.col("name").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return (
        rows.select("vec_id", "name", "check")
        .join(known, ["name", "check"], "left")
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            component.alias("component_id"),
            F.col("vec_id").eqNullSafe(component).alias("kept"),
        )
    )
