"""Removal of repeated lines, decided on hashes and returned as per-document bitmaps.

Lines travel as two 64-bit halves of a hash of their key (BLAKE2b, taken in Python workers, where
lower-casing A-Z by bytes is cheap) with the document and the position, never as text.
They are range-partitioned by hash and document, so that even one line in every document is dealt
to many tasks, and sorted by hash, document and position within each. One pass over a partition
then sees each hash's occurrences in order: the first one, how many documents hold it, and the
rest. Only the first and the last hash of a partition may go on in a neighbour; for these the
pass notes what it counted, and one small join (two rows a partition) settles them.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heartwood.llm.common import SPACES, give_back, store, text_buffers, text_id

#: rows that a task gives at once, about
LINES = 100_000


def _line_rows(min_length: int):
    """Arrow function: a row per line whose key has ``min_length`` code points or more."""

    def lines(batch: pa.RecordBatch, keys: list[bytes], rows: list[int], pos: list[int]):
        pair = np.frombuffer(b"".join(keys), np.int64).reshape(-1, 2)
        at = pa.array(rows, pa.int64())
        return pa.record_batch(
            {
                "key_a": pair[:, 0].copy(),
                "key_b": pair[:, 1].copy(),
                **{c: batch.column(c).take(at) for c in ("doc_id", "text_a", "text_b")},
                "pos": pa.array(pos, pa.int32()),
            }
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys: list[bytes] = []
            rows: list[int] = []
            pos: list[int] = []
            data, offsets = text_buffers(batch.column("text"))
            for row, (lo, hi) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
                # of bytes, lower() changes A-Z only
                for k, line in enumerate(data[lo:hi].tobytes().lower().split(b"\n")):
                    key = line.strip(SPACES)
                    # a code point has one to four bytes
                    if len(key) < min_length or (
                        len(key) < 4 * min_length
                        and len(key.decode("utf-8", "replace")) < min_length
                    ):
                        continue
                    keys.append(blake2b(key, digest_size=16).digest())
                    rows.append(row)
                    pos.append(k)
                if len(keys) >= LINES:
                    yield lines(batch, keys, rows, pos)
                    keys, rows, pos = [], [], []
            if keys:
                yield lines(batch, keys, rows, pos)
        give_back()

    return run


def _line_hashes(docs: DataFrame, min_length: int) -> DataFrame:
    """A row per line whose key is long enough: key_a, key_b, doc_id, text_a, text_b, pos.

    A key is the line without white space ``[\\x20\\x09-\\x0D]`` at both ends, A-Z lower-cased.
    """
    return docs.select("doc_id", "text_a", "text_b", "text").mapInArrow(
        _line_rows(min_length),
        "key_a long, key_b long, doc_id long, text_a long, text_b long, pos int",
    )


_FOUND = (
    "key_a long, key_b long, doc_id long, text_a long, text_b long, pos int, "
    "docs int, open boolean, note boolean"
)


def _stream(keep_first: bool, min_docs: int):
    """Arrow function on sorted lines: occurrences beyond the first of each key (or all), with
    the number of documents that hold the key here. ``open``: the key may go on in another
    partition, and all its occurrences are given, after one row (``note``) with the count."""

    def settle(part: dict[str, np.ndarray], open_first: bool, open_last: bool):
        a, b = part["key_a"], part["key_b"]
        n = len(a)
        new = np.ones(n, bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        heads = np.flatnonzero(new)
        group = np.cumsum(new) - 1
        doc, missing = part["doc_id"], part["no_id"]
        another = new.copy()
        another[1:] |= (doc[1:] != doc[:-1]) | (missing[1:] != missing[:-1])
        docs = np.add.reduceat(another, heads, dtype=np.int64) if n else np.zeros(0, np.int64)
        undecided = np.zeros(len(heads), bool)
        if len(heads):
            undecided[0] |= open_first
            undecided[-1] |= open_last
        give = undecided[group] | (docs[group] >= min_docs)
        if keep_first:
            give &= ~new | undecided[group]
        at = np.flatnonzero(give)
        notes = heads[undecided]
        rows = np.concatenate([at, notes])
        return pa.record_batch(
            {
                "key_a": a[rows],
                "key_b": b[rows],
                "doc_id": pa.array(doc[rows], pa.int64(), mask=missing[rows]),
                "text_a": part["text_a"][rows],
                "text_b": part["text_b"][rows],
                "pos": part["pos"][rows],
                "docs": docs[group[rows]].astype(np.int32),
                "open": undecided[group[rows]],
                "note": np.arange(len(rows)) >= len(at),
            }
        )

    def read(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
        doc = batch.column("doc_id")
        out = {
            c: batch.column(c).to_numpy() for c in ("key_a", "key_b", "text_a", "text_b", "pos")
        }
        out["doc_id"] = doc.fill_null(0).to_numpy()
        out["no_id"] = doc.is_null().to_numpy(zero_copy_only=False)
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict[str, np.ndarray]] = []  # occurrences of the last key so far
        begun = False
        for batch in batches:
            if not batch.num_rows:
                continue
            part = read(batch)
            last = (part["key_a"] == part["key_a"][-1]) & (part["key_b"] == part["key_b"][-1])
            cut = int(np.argmax(last))
            if held and cut == 0 and (
                held[0]["key_a"][0] == part["key_a"][0] and held[0]["key_b"][0] == part["key_b"][0]
            ):
                held.append(part)
                continue
            done = [*held, {c: x[:cut] for c, x in part.items()}]
            whole = {c: np.concatenate([d[c] for d in done]) for c in part}
            if len(whole["pos"]):
                yield settle(whole, not begun, False)
                begun = True
            held = [{c: x[cut:] for c, x in part.items()}]
        if held:
            whole = {c: np.concatenate([d[c] for d in held]) for c in held[0]}
            yield settle(whole, not begun, True)

    return run


def dropped_lines(
    docs: DataFrame, min_docs: int, keep_first: bool = False, min_length: int = 1
) -> DataFrame:
    """The lines that go: text_a, text_b, pos and doc_id (null where that is missing).

    ``docs`` has doc_id, text_a, text_b, text. A line goes if its key has ``min_length`` code
    points or more and is found in ``min_docs`` documents (different doc_ids) or more; with
    ``keep_first`` its first occurrence, by document and position, stays.
    """
    # stored, since range partitioning reads its input twice
    found = store(
        store(_line_hashes(docs, min_length))
        .repartitionByRange("key_a", "key_b", "doc_id")
        .sortWithinPartitions("key_a", "key_b", "doc_id", "text_a", "text_b", "pos")
        .mapInArrow(_stream(keep_first, min_docs), _FOUND)
    )
    place = F.struct("doc_id", "text_a", "text_b", "pos")
    # two rows a partition at most, whatever the input: fit to be broadcast
    totals = (
        found.where("open and note")
        .groupBy("key_a", "key_b")
        .agg(F.sum("docs").alias("total"), F.min(place).alias("first"))
        .where(F.col("total") >= min_docs)
    )
    late = found.where("open and not note").join(F.broadcast(totals), ["key_a", "key_b"])
    if keep_first:
        late = late.where(~place.eqNullSafe(F.col("first")))
    columns = ["doc_id", "text_a", "text_b", "pos"]
    return found.where("not open").select(columns).union(late.select(columns))


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A compressed bitmap of each document's kept lines, from the positions of those dropped."""
    for batch in batches:
        maps = []
        for n, gone in zip(batch.column("n_lines").to_pylist(), batch.column("gone")):
            keep = np.ones(n, np.uint8)
            if gone.is_valid:
                keep[gone.values.to_numpy()] = 0
            maps.append(zlib.compress(np.packbits(keep).tobytes()))
        yield pa.record_batch(
            {
                **{c: batch.column(c) for c in batch.schema.names if c != "gone"},
                "keep": pa.array(maps, pa.binary()),
            }
        )


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n_lines, n_dropped, kept = [], [], []
        for text, gone in zip(batch.column("text"), batch.column("gone")):
            lines = (text.as_py() or "").split("\n")
            n_lines.append(len(lines))
            drop = set(gone.values.to_numpy().tolist()) if gone.is_valid else ()
            n_dropped.append(len(drop))
            if drop:
                kept.append("\n".join([x for i, x in enumerate(lines) if i not in drop]))
            else:
                kept.append(text.as_py() or "")
        rest = [c for c in batch.schema.names if c not in ("text", "gone")]
        yield pa.record_batch(
            {
                **{c: batch.column(c) for c in rest},
                "n_lines": pa.array(n_lines, pa.int64()),
                "n_dropped": pa.array(n_dropped, pa.int64()),
                "kept": pa.array(kept, pa.string()),
            }
        )


def _named(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
        *text_id(F.col("text")),
    )


def _with_dropped(named: DataFrame, dropped: DataFrame) -> DataFrame:
    """The rows of ``named`` with the positions of their dropped lines (null: none)."""
    gone = (
        dropped.withColumn("no_id", F.col("doc_id").isNull())
        .withColumn("doc_id", F.coalesce("doc_id", F.lit(0)))
        .groupBy("doc_id", "no_id", "text_a", "text_b")
        .agg(F.sort_array(F.collect_set("pos")).alias("gone"))
    )
    keyed = named.withColumn("no_id", F.col("doc_id").isNull()).withColumn(
        "doc_id", F.coalesce("doc_id", F.lit(0))
    )
    return (
        keyed.join(gone, ["doc_id", "no_id", "text_a", "text_b"], "left")
        .withColumn("doc_id", F.expr("if(no_id, null, doc_id)"))
        .drop("no_id", "text_a", "text_b")
    )


def keep_bitmaps(
    docs: DataFrame, min_docs: int = 2, keep_first: bool = True, min_length: int = 1
) -> DataFrame:
    """doc_id, n_lines and keep: a zlib-compressed bitmap, first line in the highest bit, of the
    lines that stay. No text is moved. See ``drop_common_lines`` for what counts as a line."""
    named = _named(docs)
    dropped = dropped_lines(named, min_docs, keep_first, min_length)
    sized = named.withColumn("n_lines", F.size(F.split("text", "\n", -1))).drop("text")
    return _with_dropped(sized, dropped).mapInArrow(
        _bitmaps, "doc_id long, n_lines int, keep binary"
    )


def drop_common_lines(
    docs: DataFrame,
    min_docs: int = 10,
    keep_first: bool = False,
    min_length: int = 1,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Documents without the lines that many documents share: doc_id, the ``carry`` columns,
    n_lines (before), n_dropped, kept (the other lines, joined by newlines).

    Texts are split at ``\\n``; a missing or empty text is one empty line. A line's key is the
    line without white space at its ends, A-Z lower-cased; keys shorter than ``min_length`` code
    points never go. Rows with one doc_id are one document when documents are counted, and rows
    without doc_id are one document together; each row is cut by its own lines. Columns of
    ``docs`` other than doc_id, text and ``carry`` play no role; an empty table gives an empty
    result.
    """
    named = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
        *text_id(F.col("text")),
        *[F.col(c).alias(f"carry_{c}") for c in carry],
    )
    dropped = dropped_lines(
        named.select("doc_id", "text", "text_a", "text_b"), min_docs, keep_first, min_length
    )
    fields = [named.schema[f"carry_{c}"] for c in carry]
    schema = "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in fields)
    return (
        _with_dropped(named, dropped)
        .mapInArrow(_apply, f"doc_id long{schema}, n_lines long, n_dropped long, kept string")
        .withColumnsRenamed({f"carry_{c}": c for c in carry})
    )
