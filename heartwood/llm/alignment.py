"""Alignment of two tokenizers' ids, by pair counts over a minimal perfect hash.

A text is encoded by both tokenizers once and the ids are kept. Byte offsets where a token of
each ends are links of the two ids. The distinct pairs of linked ids get a minimal perfect hash:
levels of bits on which a key that lands alone keeps its place; the rank of its bit is its number.
Pairs are counted per task in dense vectors by number, which are summed as a tree, slice by slice.
A second pass aligns the kept ids again and looks the counts up; each number's key is compared, so
an unknown pair is never taken for a known one.

Of two tokens that end together, the shorter one's bytes end the longer one's. So a token has at
most as many partners that are not longer as it has bytes, and distinct pairs are bounded by the
bytes of both vocabularies together, whatever the corpus: hash and counts are some megabytes.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heartwood.llm.byte_bpe import read_file
from heartwood.llm.common import mix, row_blocks, store, text_buffers

#: numbers of a dense vector that travel together
SLICE = 8192
#: subtrees of the sum of dense vectors
BRANCHES = 32
#: bytes of the texts that are encoded together
BYTES = 1_000_000
#: entries of a word table, of which a worker has two; words that are learnt together
ENTRIES, WORDS = 100_000, 2000


# --- encoding -----------------------------------------------------------------


class Encoders:
    """Both tokenizers on texts, by a table of what lies between spaces.

    Byte-level BPE cuts a text before a space that stands alone, and so does a model without
    pieces that go on over a space. There the ids of a text are those of its words, each with the
    space before it, and as both end a token where a word ends, groups are those of its words too.
    Texts with a space beside other white space on both sides, at an end, or with U+2581, a space
    to a piece model, are encoded whole.
    """

    def __init__(self, byte_level: str, pieces: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.first = Tokenizer.from_file(byte_level)
        self.first.encode_special_tokens = True  # their strings are plain text
        self.second = SentencePieceProcessor(model_file=pieces)
        spec, special, of_byte = read_file(byte_level)
        size = max([*of_byte, *special.values()]) + 1
        self.bytes_a = [of_byte.get(i, b"") for i in range(size)]
        names = [self.second.id_to_piece(i) for i in range(self.second.get_piece_size())]
        self.bytes_b = [
            bytes([int(name[3:5], 16)])
            if self.second.is_byte(i)
            else name.replace("▁", " ").encode()
            for i, name in enumerate(names)
        ]
        crossing = any("▁" in name.lstrip("▁") for name in names)
        self.whole = re.compile("" if crossing else r"  |\s \s|^ | \Z|▁")
        self.lengths_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.lengths_b = np.array([len(x) for x in self.bytes_b], np.int64)
        #: ids are kept in two bytes where that is enough
        self.kind = id_kind(len(self.bytes_a), len(self.bytes_b))
        self.digits = [str(i) for i in range(max(len(self.bytes_a), len(self.bytes_b)))]
        # words met lately, and before that
        self.words: dict[str, tuple[bytes, bytes, str] | None] = {}
        self.older: dict[str, tuple[bytes, bytes, str] | None] = {}

    def _ids(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of a text with a space before it; None where the tokens do not give back its bytes."""
        a = self.first.encode(" " + text, add_special_tokens=False).ids
        b = self.second.encode(text)
        whole = b" " + text.encode()
        if (
            b"".join([self.bytes_a[i] for i in a]) != whole
            or b"".join([self.bytes_b[i] for i in b]) != whole
        ):
            return None
        return np.array(a, self.kind), np.array(b, self.kind)

    def _groups(self, a: np.ndarray, b: np.ndarray) -> tuple[list[str], np.ndarray]:
        """The groups of a text's ids, and the place in ``a`` at which each one ends."""
        to_a, to_b = link_places(a, b, self.lengths_a, self.lengths_b)
        text_a, text_b = [self.digits[i] for i in a.tolist()], [self.digits[i] for i in b.tolist()]
        out, i, j = [], 0, 0
        for x, y in zip((to_a + 1).tolist(), (to_b + 1).tolist()):
            out.append(",".join(text_a[i:x]) + "|" + ",".join(text_b[j:y]))
            i, j = x, y
        return out, to_a

    def _whole(self, text: str) -> tuple[bytes, bytes, str] | None:
        """Ids of both tokenizers and groups of a text with a space before it."""
        ids = self._ids(text)
        if ids is None:
            return None
        return ids[0].tobytes(), ids[1].tobytes(), ";".join(self._groups(*ids)[0])

    def _learn(self, words: list[str]) -> None:
        """Words encoded as one text and cut apart where they end."""
        joined = " ".join(words)
        ids = None if self.whole.search(joined) else self._ids(joined)
        if ids is None:  # one of them, or two on end, is no plain text
            self.words.update((w, self._whole(w)) for w in words)
            return
        a, b = ids
        groups, ends = self._groups(a, b)
        stops = np.cumsum(np.array([len(w.encode()) + 1 for w in words]))
        cut_a = np.searchsorted(np.cumsum(self.lengths_a[a]), stops) + 1
        cut_b = np.searchsorted(np.cumsum(self.lengths_b[b]), stops) + 1
        width = np.dtype(self.kind).itemsize
        cuts = zip((width * cut_a).tolist(), (width * cut_b).tolist(), np.searchsorted(ends, cut_a).tolist())
        data_a, data_b = a.tobytes(), b.tobytes()
        i = j = k = 0
        for word, (x, y, z) in zip(words, cuts):
            self.words[word] = data_a[i:x], data_b[j:y], ";".join(groups[k:z])
            i, j, k = x, y, z

    def encode(self, texts: list[str]) -> list[tuple[bytes, bytes, str]]:
        """Ids of both tokenizers and groups; empty for an empty text or one that either changes."""
        plain = [not self.whole.search(t) for t in texts]
        split = [t.split(" ") if p else [] for t, p in zip(texts, plain)]
        missing = set().union(*split).difference(self.words)
        if len(self.words) + len(missing) > ENTRIES:  # words not met again are forgotten
            self.older, self.words = self.words, {}
            missing = set().union(*split)
        known = missing & self.older.keys()
        self.words.update((w, self.older[w]) for w in known)
        new = list(missing - known)
        for at in range(0, len(new), WORDS):
            self._learn(new[at : at + WORDS])
        words = self.words
        out = []
        for text, parts, p in zip(texts, split, plain):
            found = [words[w] for w in parts] if p else [self._whole(text)]
            if not text or None in found:
                out.append((b"", b"", ""))
            else:
                a, b, groups = zip(*found)
                out.append((b"".join(a), b"".join(b), ";".join(groups)))
        for w in new:
            if len(w) > 60:
                del words[w]
        return out


@cache
def _encoders(byte_level: str, pieces: str) -> Encoders:
    """A Python worker keeps its word tables from task to task."""
    return Encoders(byte_level, pieces)


@dataclass(frozen=True)
class Sizes:
    """What the passes over kept ids need of both vocabularies: the bytes of each token."""

    a: np.ndarray
    b: np.ndarray
    kind: str


def id_kind(*sizes: int) -> str:
    return "<u2" if max(sizes) <= 1 << 16 else "<u4"


# --- alignment ----------------------------------------------------------------


def link_places(
    a: np.ndarray, b: np.ndarray, lengths_a: np.ndarray, lengths_b: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``a`` and in ``b`` of the tokens that end together, in order."""
    ends_a, ends_b = np.cumsum(lengths_a[a]), np.cumsum(lengths_b[b])
    at = np.searchsorted(ends_b, ends_a)
    at[at == len(b)] = 0
    together = ends_b[at] == ends_a if len(b) else np.zeros(len(a), bool)
    return np.flatnonzero(together), at[together]


def pair_key(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a.astype(np.uint64) << np.uint64(32) | b.astype(np.uint64)


@dataclass
class PerfectHash:
    """Numbers 0 to n - 1 for n distinct keys.

    Level by level, the keys left are hashed onto a few more places than there are keys; those
    that land alone keep their place, the others go on to the next level. A key's number is the
    rank of its place. A sixth of the places or so is used, and some twenty levels.
    """

    levels: list[tuple[int, np.ndarray, np.ndarray]]  # places, rank before each, used
    keys: np.ndarray  # by number

    @classmethod
    def of(cls, keys: np.ndarray) -> PerfectHash:
        keys = np.unique(keys.astype(np.uint64))
        left, levels, placed, first = keys, [], [], 0
        while len(left):
            size = max(2 * len(left), 16)
            at = _place(left, len(levels), size)
            hits = np.bincount(at, minlength=size)
            alone = hits == 1
            rank = first + np.cumsum(alone) - alone
            levels.append((size, rank.astype(np.int64), alone))
            fits = alone[at]
            order = np.argsort(at[fits])
            placed.append(left[fits][order])
            first += int(alone.sum())
            left = left[~fits]
        return cls(levels, np.concatenate(placed) if placed else keys)

    def number(self, keys: np.ndarray) -> np.ndarray:
        """Numbers of the keys, -1 for one that was not among those hashed."""
        keys = keys.astype(np.uint64)
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, (size, rank, alone) in enumerate(self.levels):
            if not len(left):
                break
            at = _place(keys[left], level, size)
            hit = alone[at]
            out[left[hit]] = rank[at[hit]]
            left = left[~hit]
        found = out >= 0
        found[found] = self.keys[out[found]] == keys[found]
        return np.where(found, out, -1)


def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    seed = np.uint64((level + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    return (mix(keys ^ seed) % np.uint64(size)).astype(np.int64)


# --- tasks --------------------------------------------------------------------


def _encode(byte_level: str, pieces: str):
    """Arrow function: ids of both tokenizers, and the digest of their groups, for each text."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = _encoders(byte_level, pieces)
        for batch in batches:
            _, offsets = text_buffers(batch.column("text"))
            for first, last in row_blocks(offsets, BYTES):
                part = batch.slice(first, last - first)
                found = both.encode([t or "" for t in part.column("text").to_pylist()])
                yield pa.record_batch(
                    {
                        "doc_id": part.column("doc_id"),
                        "ids_a": pa.array([a for a, _, _ in found], pa.binary()),
                        "ids_b": pa.array([b for _, b, _ in found], pa.binary()),
                        "groups_sha256": pa.array(
                            [
                                hashlib.sha256(groups.encode()).hexdigest() if a else ""
                                for a, _, groups in found
                            ],
                            pa.string(),
                        ),
                    }
                )

    return encode


def _links(
    batch: pa.RecordBatch, sizes: Sizes
) -> tuple[np.ndarray, list[np.ndarray]]:
    """Keys of all links of some encoded documents, and for each its ids A, ids B and links.

    The ids of all of them on end are aligned at once: every document's tokens end together.
    """
    sides, places = [], []
    for name in ("ids_a", "ids_b"):
        data, offsets = text_buffers(batch.column(name))
        sides.append(data.view(sizes.kind))
        places.append(offsets // np.dtype(sizes.kind).itemsize)
    to_a, to_b = link_places(*sides, sizes.a, sizes.b)
    numbers = [np.diff(offsets) for offsets in places]
    numbers.append(np.diff(np.searchsorted(to_a, places[0])))
    return pair_key(sides[0][to_a], sides[1][to_b]), numbers


def _count_pairs(sizes: Sizes):
    """Arrow function: the pairs linked in a task's documents and how often, once per task."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _encoders.cache_clear()  # encoding is over: give its memory back
        keys, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for batch in batches:
            for part in _blocks(batch):
                new, n = np.unique(_links(part, sizes)[0], return_counts=True)
                keys, inverse = np.unique(np.concatenate([keys, new]), return_inverse=True)
                merged = np.zeros(len(keys), np.int64)
                np.add.at(merged, inverse, np.concatenate([counts, n]))
                counts = merged
        if len(keys):
            yield pa.record_batch(
                {"pair": pa.array(keys.astype(np.int64)), "n": pa.array(counts, pa.int64())}
            )

    return count


def _blocks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows whose ids have some megabytes together."""
    _, offsets = text_buffers(batch.column("ids_a"))
    for first, last in row_blocks(offsets, BYTES):
        yield batch.slice(first, last - first)


def _dense(hashed):
    """Arrow function: a task's pair counts as slices of one dense vector."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = hashed.value
        dense = np.zeros(-(-len(table.keys) // SLICE) * SLICE, np.int64)
        for batch in batches:
            number = table.number(batch.column("pair").to_numpy().astype(np.uint64))
            np.add.at(dense, number, batch.column("n").to_numpy())
        used = [k for k in range(len(dense) // SLICE) if dense[k * SLICE : (k + 1) * SLICE].any()]
        yield pa.record_batch(
            {
                "slice": pa.array(used, pa.int32()),
                "counts": pa.array(
                    [dense[k * SLICE : (k + 1) * SLICE].tobytes() for k in used], pa.binary()
                ),
            }
        )

    return spread


def _add(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow function on rows sorted by slice: each slice's vectors as their sum."""
    current, total = None, None
    done: list[tuple[int, bytes]] = []
    for batch in tables:
        for k, counts in zip(batch.column("slice").to_pylist(), batch.column("counts")):
            part = np.frombuffer(counts.as_py(), np.int64)
            if k == current:
                total = total + part
            else:
                if current is not None:
                    done.append((current, total.tobytes()))
                current, total = k, part
    if current is not None:
        done.append((current, total.tobytes()))
    yield pa.record_batch(
        {
            "slice": pa.array([k for k, _ in done], pa.int32()),
            "counts": pa.array([c for _, c in done], pa.binary()),
        }
    )


def _look_up(sizes: Sizes, shared):
    """Arrow function: the figures of each document, its links aligned again."""

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _encoders.cache_clear()
        table, counts, best = shared.value
        for batch in batches:
            for part in _blocks(batch):
                keys, (n_a, n_b, n_links) = _links(part, sizes)
                number = table.number(keys)
                if (number < 0).any():
                    raise ValueError("a link that was not counted")
                ends = np.cumsum(n_links)

                def per_document(figures: np.ndarray) -> pa.Array:
                    sums = np.concatenate([[0], np.cumsum(figures, dtype=np.int64)])
                    return pa.array(sums[ends] - sums[ends - n_links], pa.int64())

                yield pa.record_batch(
                    {
                        "doc_id": part.column("doc_id"),
                        "n_a": pa.array(n_a, pa.int64()),
                        "n_b": pa.array(n_b, pa.int64()),
                        # every link ends a group, and only links do
                        "n_groups": pa.array(n_links, pa.int64()),
                        "n_links": pa.array(n_links, pa.int64()),
                        "n_best": per_document(best[number]),
                        "count_sum": per_document(counts[number]),
                        "groups_sha256": part.column("groups_sha256"),
                    }
                )

    return look_up


# --- operator -----------------------------------------------------------------


def pair_counts(encoded: DataFrame, sizes: Sizes) -> tuple[PerfectHash, np.ndarray]:
    """Hash of the distinct linked pairs of an encoded corpus, and their counts by number."""
    spark = encoded.sparkSession
    per_task = store(encoded.mapInArrow(_count_pairs(sizes), "pair long, n long"))
    # bounded by the vocabularies, see above
    keys = per_task.select("pair").distinct().toArrow()["pair"].to_numpy().astype(np.uint64)
    table = PerfectHash.of(keys)
    if len(table.keys) > int(sizes.a.sum() + sizes.b.sum()):
        raise ValueError("more pairs than these vocabularies can link")
    dense = np.zeros(-(-len(table.keys) // SLICE) * SLICE, np.int64)
    shared = spark.sparkContext.broadcast(table)
    rows = "slice int, counts binary"
    parts = per_task.mapInArrow(_dense(shared), rows)
    branch = F.pmod(F.monotonically_increasing_id() + F.spark_partition_id(), F.lit(BRANCHES))
    for keys_of_level in (["branch", "slice"], ["slice"]):
        parts = (
            parts.withColumn("branch", branch)
            .repartition(*keys_of_level)
            .sortWithinPartitions("slice")
            .select("slice", "counts")
            .mapInArrow(_add, rows)
        )
    for row in parts.toArrow().to_pylist():
        dense[row["slice"] * SLICE : (row["slice"] + 1) * SLICE] += np.frombuffer(
            row["counts"], np.int64
        )
    return table, dense[: len(table.keys)]


def best_of_second(table: PerfectHash, counts: np.ndarray) -> np.ndarray:
    """Whether a pair's count is the highest of its second id, by number; ties all are."""
    second = (table.keys & np.uint64(0xFFFFFFFF)).astype(np.int64)
    highest = np.zeros(int(second.max(initial=0)) + 1, np.int64)
    np.maximum.at(highest, second, counts)
    return counts == highest[second]


def align(docs: DataFrame, byte_level: str, pieces: str) -> DataFrame:
    """Rows (doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256).

    Token A is of the byte-level BPE file on a space and the text, token B of the piece model on
    the text, which adds that space; special tokens are plain text. A missing or empty text, and
    one whose tokens of either side do not give back its bytes, has zeros and an empty digest.
    Every row is a document of its own, also with a repeated or missing doc_id, and counts for
    the corpus; an empty table gives an empty result. Long texts are encoded whole; other columns
    of ``docs`` play no role.

    Texts are encoded once and their ids stored; both passes align the stored ids.
    """
    spark = docs.sparkSession
    encoded = store(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
            _encode(byte_level, pieces),
            "doc_id long, ids_a binary, ids_b binary, groups_sha256 string",
        )
    )
    both = Encoders(byte_level, pieces)
    sizes = Sizes(both.lengths_a, both.lengths_b, both.kind)
    table, counts = pair_counts(encoded, sizes)
    shared = spark.sparkContext.broadcast((table, counts, best_of_second(table, counts)))
    return encoded.mapInArrow(
        _look_up(sizes, shared),
        "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, "
        "count_sum long, groups_sha256 string",
    )
