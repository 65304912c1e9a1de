"""Nearest neighbours by cross-polytope hashing with multiple probes.

A table rotates unit vectors by a pseudo-random rotation, three rounds of sign flips and a fast
Hadamard transform, and files each vector under the signed axis that is nearest to it. A query
looks at its nearest axes in every table, so the neighbours that a table files elsewhere are
mostly found in another one. All vectors of a probed bucket are ranked by their exact distance.

Vectors with equal contents are one class, of which the k + 1 smallest ids matter: no more can be
among the k nearest of a query, its own row left out. A bucket with many vectors is dealt to
several blocks, of which each returns its own nearest, so neither side of a task's work grows
with the bucket.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heartwood.llm.common import store
from heartwood.llm.vectors import matrix, usable, vector_id

TABLES = 12
PROBES = 12
#: vectors and queries that meet in one task
BLOCK, QUERY_BLOCK = 20_000, 1_000


def rotated(vectors: np.ndarray, table: int) -> np.ndarray:
    """Unit vectors after the table's pseudo-rotation, padded to a power of two."""
    n, d = vectors.shape
    wide = 1 << max(d - 1, 0).bit_length()
    x = np.zeros((n, wide))
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)  # lengths may overflow
    x[:, :d] = scaled / np.linalg.norm(scaled, axis=1, keepdims=True)
    random = np.random.default_rng([table, wide])
    for _ in range(3):
        x = x * random.choice([-1.0, 1.0], wide)
        half = 1
        while half < wide:
            x = x.reshape(n, -1, 2, half)
            x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2)
            half *= 2
        x = x.reshape(n, wide) / np.sqrt(wide)
    return x


def signed_axes(vectors: np.ndarray, table: int, probes: int) -> np.ndarray:
    """The ``probes`` nearest signed axes of each vector, nearest first."""
    x = rotated(vectors, table)
    both = np.concatenate([x, -x], axis=1)
    return np.argsort(-both, axis=1, kind="stable")[:, :probes]


def _filed(probes: int | None):
    """Arrow function: a row per vector, table and probed axis (all of table 0 if None)."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            size = np.array(batch.column("size"))
            for d in np.unique(size).tolist():
                rows = batch.filter(pa.array(size == d))
                x = matrix(rows.column("vector"))
                axes = 2 * (1 << max(d - 1, 0).bit_length())
                if probes is None:
                    found = [np.tile(np.arange(axes), (len(x), 1))]
                else:
                    found = [signed_axes(x, t, min(probes, axes)) for t in range(TABLES)]
                for table, axis in enumerate(found):
                    for k in range(axis.shape[1]):
                        yield pa.record_batch(
                            {
                                **{c: rows.column(c) for c in rows.schema.names},
                                "table": np.full(len(x), table, np.int32),
                                "axis": axis[:, k].astype(np.int32),
                            }
                        )

    return run


def _nearest(k: int):
    """Arrow function on one block of a bucket and the queries that probe it."""

    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        out_a, out_b, out_id, out_score = [], [], [], []
        if left.num_rows and right.num_rows:
            x, q = matrix(left.column("vector")), matrix(right.column("vector"))
            lists = left.column("ids").combine_chunks()
            at, ids = lists.offsets.to_numpy(), lists.flatten().to_numpy()
            at = at - at[0]
            least = ids[at[:-1]]
            qa, qb = (right.column(c).to_numpy() for c in ("vector_a", "vector_b"))
            for i in range(len(q)):
                distance = np.sqrt(((x - q[i]) ** 2).sum(axis=1))
                if len(x) > k + 1:
                    bound = np.partition(distance, k)[k]
                    near = np.flatnonzero(distance <= bound)
                    near = near[np.lexsort((least[near], distance[near]))][: k + 1]
                else:
                    near = np.arange(len(x))
                each = np.concatenate([ids[at[j] : at[j + 1]] for j in near])
                score = np.repeat(distance[near], at[near + 1] - at[near])
                keep = np.lexsort((each, score))[: k + 1]
                out_a.append(np.full(len(keep), qa[i]))
                out_b.append(np.full(len(keep), qb[i]))
                out_id.append(each[keep])
                out_score.append(score[keep])
        join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
        return pa.table(
            {
                "vector_a": join(out_a, np.int64),
                "vector_b": join(out_b, np.int64),
                "vec_id": join(out_id, np.int64),
                "score": join(out_score, np.float64),
            }
        )

    return run


def _classes(rows: DataFrame, keep: int) -> DataFrame:
    """Vectors by contents with their ``keep`` smallest ids, each once however often it is there;
    repeats go, and the limit acts, before rows are shuffled."""
    ranks = Window.partitionBy("vector_a", "vector_b").orderBy("vec_id")
    return (
        rows.groupBy("vector_a", "vector_b", "vec_id")
        .agg(F.first("vector").alias("vector"), F.first("size").alias("size"))
        .withColumn("place", F.row_number().over(ranks))
        .where(F.col("place") <= keep)
        .groupBy("vector_a", "vector_b")
        .agg(
            F.first("vector").alias("vector"),
            F.first("size").alias("size"),
            F.sort_array(F.collect_set("vec_id")).alias("ids"),
        )
    )


def _found(index: DataFrame, sizes: DataFrame, queries: DataFrame, probes: int | None, k: int):
    """The k + 1 nearest ids of each query class, among the vectors in its probed buckets."""
    kind = index.schema["vector"].dataType.simpleString()
    columns = f"vector_a long, vector_b long, vector {kind}, size int, table int, axis int"
    probing = queries.select("vector_a", "vector_b", "vector", "size").mapInArrow(
        _filed(probes), columns
    )
    bucket = ["size", "table", "axis"]
    # a row per bucket: bounded by tables and axes
    asked = probing.groupBy(*bucket).agg(F.count("*").alias("asked"))
    plan = (
        sizes.join(asked, bucket)
        .withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
        .withColumn("query_blocks", F.ceil(F.col("asked") / QUERY_BLOCK).cast("int"))
        .select(*bucket, "blocks", "query_blocks")
    )

    def dealt(rows: DataFrame, own: str, others: str, own_name: str, other_name: str) -> DataFrame:
        spread = F.pmod(F.xxhash64("vector_b", "table"), F.col(own)).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.col(others) - 1))
        return (
            rows.join(plan, bucket)
            .withColumn(own_name, spread)
            .withColumn(other_name, every)
            .drop("blocks", "query_blocks")
        )

    left = dealt(index, "blocks", "query_blocks", "block", "query_block")
    right = dealt(probing, "query_blocks", "blocks", "query_block", "block")
    key = [*bucket, "block", "query_block"]
    near = (
        left.groupBy(*key)
        .cogroup(right.groupBy(*key))
        .applyInArrow(_nearest(k), "vector_a long, vector_b long, vec_id long, score double")
        .groupBy("vector_a", "vector_b", "vec_id")
        .agg(F.min("score").alias("score"))
    )
    best = Window.partitionBy("vector_a", "vector_b").orderBy("score", "vec_id")
    return near.withColumn("place", F.row_number().over(best)).where(f"place <= {k + 1}")


def nearest_neighbours(
    vectors: DataFrame, is_query: Column, k: int = 10, probes: int = PROBES
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest rows found for each query row.

    ``vectors`` has vec_id and embedding; ``is_query`` is a condition on it. Nearest is the
    smallest Euclidean distance of the original vectors in double precision, ties go to the
    smaller vec_id. A row never answers its own query; rows with one vec_id are one row of each
    of its vectors. Vectors that are missing, zero, or have missing or non-finite components,
    and rows without vec_id, take no part. Vectors of different lengths are not compared. A
    query with fewer than ``k`` rows found looks at every bucket of one table, so it gets all
    rows if there are no more. Other columns play no role; an empty table gives an empty result.
    """
    # the column's own precision
    single = vectors.schema["embedding"].dataType.simpleString() == "array<float>"
    kind = "array<float>" if single else "array<double>"
    rows = (
        vectors.where(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
        .select(
            F.col("vec_id").cast("long").alias("vec_id"),
            F.col("embedding").cast(kind).alias("vector"),
            F.coalesce(is_query, F.lit(False)).alias("asks"),
        )
        .withColumns({"size": F.size("vector")})
        .select("*", *vector_id(F.col("vector")))
    )
    classes = store(_classes(rows, k + 1))
    asking = rows.where("asks").select(F.col("vec_id").alias("query_id"), "vector_a", "vector_b")
    queries = store(
        rows.where("asks").groupBy("vector_a", "vector_b").agg(
            F.first("vector").alias("vector"), F.first("size").alias("size")
        )
    )
    index = classes.mapInArrow(
        _filed(1),
        f"vector_a long, vector_b long, vector {kind}, size int, ids array<long>, "
        "table int, axis int",
    )
    sizes = store(index.groupBy("size", "table", "axis").agg(F.count("*").alias("n")))
    found = store(_found(index, sizes, queries, probes, k))
    few = queries.join(
        found.groupBy("vector_a", "vector_b").count().where(F.col("count") > k),
        ["vector_a", "vector_b"],
        "left_anti",
    )
    rest = _found(index.where(F.col("table") == 0), sizes, few, None, k)
    complete = found.join(few, ["vector_a", "vector_b"], "left_anti").unionByName(rest)
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        asking.distinct()
        .join(complete, ["vector_a", "vector_b"])
        .where("query_id <> vec_id")
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
