"""What several operators share: text blocks for numpy, stored tables, connected components."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: bytes that separate words and are stripped from lines: space and \t \n \v \f \r
SPACES = b" \t\n\x0b\x0c\r"
#: links whose components the driver finds, 16 MB
FEW_LINKS = 1 << 20


def text_id(text: Column) -> list[Column]:
    """Two 64-bit hashes that together name a text; equal texts, and only they, agree in both.

    A missing text is the empty text.
    """
    whole = F.coalesce(text, F.lit(""))
    return [
        F.xxhash64(whole).alias("text_a"),
        F.xxhash64(F.lit("second"), whole).alias("text_b"),
    ]


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables: ``spark.checkpoint.dir``.

    Where the setting is missing (tests on one machine), a folder in the warehouse.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/intermediate"
    return folder.rstrip("/") + "/heartwood-" + spark.sparkContext.applicationId


def store(df: DataFrame, batch_bytes: int | None = None) -> DataFrame:
    """Write the rows as a table in the shared folder and read them from there.

    Cuts the lineage: executors may be lost afterwards, and branches over the result do
    not compute it again. ``clear_stored`` removes the tables of an application. With
    ``batch_bytes``, batches for Python workers hold about so many bytes and not only a number of
    rows, whose texts may be long.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, str(batch_bytes) if batch_bytes else before)
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(setting, before)
    return spark.read.schema(df.schema).parquet(path)


def clear_stored(spark: SparkSession) -> None:
    """Remove what ``store`` has written for this application; its results end with it."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(shared_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def give_back() -> None:
    """Return to the system what this Python worker has freed, in the tasks before too.

    Allocators keep freed memory for later use, but the next task may be another operator's.
    """
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts of a column on end, and the n + 1 places where they begin."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def row_blocks(offsets: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold about ``size`` bytes, or one row that is longer."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def mix(x: np.ndarray) -> np.ndarray:
    """A well mixed 64-bit hash of 64-bit numbers (in place)."""
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _is_settled(edges: DataFrame) -> bool:
    """Whether each node has one link, to a node without any."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("hub")).union(
        edges.select(F.col("b"), F.lit(0), F.lit(1))
    )
    per_node = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("hub").alias("hub"))
    return per_node.where("out > 1 or (out = 1 and hub = 1)").isEmpty()


def _least_reachable(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of links that reach a smaller one, and the smallest one each reaches."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    least = np.arange(len(nodes))
    while True:
        p, q = least[x], least[y]
        if (p == q).all():
            break
        # the larger of two groups' least nodes goes to the smaller, then all to where it leads
        np.minimum.at(least, np.maximum(p, q), np.minimum(p, q))
        while (least[least] != least).any():
            least = least[least]
    moved = least != np.arange(len(nodes))
    return nodes[moved], nodes[least[moved]]


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """Connected components of ``links`` (a, b): rows (node, component), the smallest node.

    Each round joins every node's larger neighbours to the smallest node of its neighbourhood, then
    its smaller ones (large star, small star), until every node is linked to its smallest and to
    nothing else. The edges of a round are stored; no node's neighbours are ever gathered, only
    their minimum. A component of diameter d takes about log d rounds. ``FEW_LINKS`` links or fewer
    go to the driver instead, which is faster than rounds over small tables.
    """
    edges = store(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where("a <> b")
        .distinct()
    )
    if edges.count() <= FEW_LINKS and {kind for _, kind in edges.dtypes} == {"bigint"}:
        found = edges.toArrow()
        node, component = _least_reachable(*(found.column(c).to_numpy() for c in ("a", "b")))
        few = pa.table({"node": node, "component": component})
        return store(edges.sparkSession.createDataFrame(few, "node long, component long"))
    for _ in range(rounds):
        if _is_settled(edges):
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(
            "a", F.least("a", "m").alias("m")
        )
        large = (
            both.join(least, "a").where("b > a and b <> m").select(F.col("b").alias("a"), "m")
        )
        down = large.union(least.where("a <> m")).distinct().toDF("a", "b")
        lowest = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(lowest, "a")
        edges = store(
            small.select("a", "m")
            .union(small.where("b <> m").select("b", "m"))
            .distinct()
            .toDF("a", "b")
        )
    raise RuntimeError(f"components did not settle in {rounds} rounds")
