"""Token sequences of bounded length, packed from documents by large-item matching and best fit.

Only the number of pieces of each length decides how sequences are filled, and there are at most
``capacity`` lengths. So the plan is made from that histogram: pieces longer than a third of the
capacity go at most two to a sequence and are matched greedily, the longest one first with the
longest that still fits; shorter pieces, longest first, go where they leave the least gap. Pieces
of one length are placed many at a time. The plan is a list of rank intervals per length, whose
size depends on the capacity and not on the corpus; each piece finds its place by its rank among
the pieces of its length.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from heartwood.llm.byte_bpe import byte_letters
from heartwood.llm.common import give_back, store

#: entries of a worker's word table; a full table keeps its short words only
WORDS = 500_000
#: bytes of texts that a worker gets at once, about
BATCH_BYTES = 8 << 20
#: texts that are encoded together
TEXTS = 64
#: pieces of one length are ranked in so many separate groups
SALTS = 64


class _Merges:
    """Byte-pair merges of many words at once, for words that the tokenizer takes as they are."""

    #: letters that are composed and that every Unicode version takes for such, and signs after
    #: them, which the tokenizer takes apart from letters
    plain = re.compile(r"([a-zA-ZÀ-ÖØ-öø-ÿ]+)([!\"#$%&()*+,\-./:;=?@\[\\\]^_`{}~]*)")
    #: the parts of a tokenizer's file that decide how a plain word is encoded
    normalizer = [
        {"type": "NFC"},
        {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
        {"type": "Lowercase"},
    ]
    cut = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
    #: of a slot in the table of pairs
    bits = 18

    @classmethod
    def of(cls, path: str) -> _Merges | None:
        """The merges of a tokenizer's file, if it is of the kind that is known here."""
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        before = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}, {}]
        known = (
            model.get("type") == "BPE"
            and model.get("end_of_word_suffix") == "</w>"
            and not any(
                model.get(x)
                for x in ("dropout", "continuing_subword_prefix", "fuse_unk", "ignore_merges")
            )
            and (spec.get("normalizer") or {}).get("normalizers") == cls.normalizer
            and before[0].get("pattern") == {"Regex": cls.cut}
            and (before[0].get("behavior"), before[0].get("invert")) == ("Removed", True)
            and before[1].get("type") == "ByteLevel"
            and not before[1].get("add_prefix_space")
            and not before[1].get("use_regex")
            and len(before) == 2
            # a special token is found before anything is cut
            and all(t["content"][:1] in ("<", " ") for t in spec["added_tokens"])
        )
        letters = {b: c for c, b in byte_letters().items()}
        names = model.get("vocab", {})
        if not known or any(c + end not in names for c in letters.values() for end in ("", "</w>")):
            return None
        return cls(names, model["merges"], letters)

    def __init__(self, names: dict[str, int], merges: list, letters: dict[int, str]):
        self.inner = np.array([names[letters[b]] for b in range(256)], np.int64)
        self.last = np.array([names[letters[b] + "</w>"] for b in range(256)], np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        self.made = np.array([names[a + b] for a, b in pairs], np.int64)
        keys = np.array([names[a] << 32 | names[b] for a, b in pairs], np.int64)
        # open addressing; a pair that is listed twice counts as the later one
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.ranks = np.full(1 << self.bits, len(keys), np.int64)
        self.none = len(keys)
        slots = self._slots(keys)
        for key, slot, rank in zip(keys.tolist(), slots.tolist(), range(len(keys))):
            while self.keys[slot] not in (-1, key):
                slot = (slot + 1) & ((1 << self.bits) - 1)
            self.keys[slot], self.ranks[slot] = key, rank

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def _rank(self, keys: np.ndarray) -> np.ndarray:
        """The rank of each pair, or as many as there are merges if it is none."""
        slots = self._slots(keys)
        got = self.keys[slots]
        ranks = np.where(got == keys, self.ranks[slots], self.none)
        rest = np.flatnonzero((got != keys) & (got != -1))
        while len(rest):
            slots[rest] = (slots[rest] + 1) & ((1 << self.bits) - 1)
            got = self.keys[slots[rest]]
            ranks[rest[got == keys[rest]]] = self.ranks[slots[rest[got == keys[rest]]]]
            rest = rest[(got != keys[rest]) & (got != -1)]
        return ranks

    def ids(self, letters: list[bytes], signs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words on end, given as their letters and the signs after them, and the n + 1
        places where those of each begin."""
        parts = [x for pair in zip(letters, signs) for x in pair]
        ids, count = self._merged([x for x in parts if x])
        has = np.array([bool(x) for x in parts])
        counts = np.zeros(len(parts), np.int64)
        counts[has] = count
        return ids, np.append(0, np.cumsum(counts[::2] + counts[1::2]))

    def _merged(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words on end, and how many each has.

        A round makes the first of the lowest merges of each word that has one.
        """
        length = np.array([len(w) for w in words])
        data = np.frombuffer(b"".join(words), np.uint8)
        ends = np.cumsum(length)
        out = self.inner[data]
        out[ends - 1] = self.last[data[ends - 1]]
        count = length.copy()
        # symbols of words that are not done: where the word's begin in out, what they are
        at, size, sym = ends - length, length, out.copy()
        word = np.arange(len(words))
        while len(word):
            first = np.cumsum(size) - size
            rank = np.full(len(sym), self.none)
            rank[:-1] = self._rank(sym[:-1] << 32 | sym[1:])
            rank[first + size - 1] = self.none
            low = np.minimum.reduceat(rank, first)
            place = np.where(rank == np.repeat(low, size), np.arange(len(sym)), len(sym))
            place = np.minimum.reduceat(place, first)
            done = low == self.none
            keep = np.repeat(~done, size)
            if done.any():
                for_done = np.flatnonzero(~keep)
                to = np.repeat((at - first)[done], size[done]) + for_done
                out[to] = sym[for_done]
                count[word[done]] = size[done]
            merged = place[~done]
            sym[merged] = self.made[low[~done]]
            keep[merged + 1] = False
            sym = sym[keep]
            word, at, size = word[~done], at[~done], size[~done] - 1
        begins = ends - length
        keep = np.arange(len(out)) < np.repeat(begins + count, length)
        return out[keep], count


def _holes(found: list) -> list[int]:
    """Where a list has None."""
    out, at = [], -1
    for _ in range(found.count(None)):
        at = found.index(None, at + 1)
        out.append(at)
    return out


class WordTokens:
    """Token ids of texts, by a table of the words met so far.

    The tokenizer has to drop white space, to keep no state across it, to lower-case, and to take
    letters and digits apart from other characters; then the ids of a text are those of its
    space-separated words in turn, and a full stop or comma after a letter or digit and before a
    space is a word of its own.
    """

    #: what special tokens look like; the tokenizer finds them before it lower-cases
    special = re.compile(r"<\|.*?\|>", re.DOTALL)
    #: stops and commas that belong to a longer run of other characters
    runs = re.compile(r"[.,](?<=[^\w\s].|_.)")

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merges = _Merges.of(path)
        self.table: dict[str, bytes] = {}

    def words(self, text: str) -> list[str]:
        # of bytes, lower() changes A-Z only
        lower = text.encode().lower().decode()
        if "<|" in text and "|>" in text:
            lower = self._kept_case(text, lower)
        text = lower.replace("\n", " ").replace("\t", " ") + " "
        if not self.runs.search(text):
            text = text.replace(", ", " , ").replace(". ", " . ")
        return text.split(" ")

    def _kept_case(self, text: str, lower: str) -> str:
        """``lower`` with what lies between ``<|`` and ``|>`` as it is in ``text``."""
        out, at = [], 0
        for found in self.special.finditer(text):
            out += [lower[at : found.start()], found.group()]
            at = found.end()
        return "".join([*out, lower[at:]])

    def _learn(self, words: list[str]) -> None:
        """Encode words: plain ones by merges, the others as one text; there a token belongs to
        the word in which it begins."""
        if self.merges is not None:
            is_plain = self.merges.plain.fullmatch
            plain, letters, signs, others = [], [], [], []
            for w in words:
                match = is_plain(w) if len(w) <= 200 else None
                if match is None:
                    others.append(w)
                else:
                    plain.append(w)
                    letters.append(match[1].lower().encode())
                    signs.append(match[2].encode())
            if plain:
                self._keep(plain, *self.merges.ids(letters, signs))
            words = others
        if words:
            found = self.tokenizer.encode(" ".join(words), add_special_tokens=False)
            begins = np.array([o[0] for o in found.offsets], np.int64)
            ends = np.cumsum(np.array([len(w) + 1 for w in words]))
            cuts = np.append(0, np.searchsorted(begins, ends))
            self._keep(words, np.array(found.ids, np.int64), cuts)

    def _keep(self, words: list[str], ids: np.ndarray, cuts: np.ndarray) -> None:
        data, cuts = ids.astype("<u4").tobytes(), (4 * cuts).tolist()
        for w, a, b in zip(words, cuts, cuts[1:]):
            self.table[w] = data[a:b]

    def ids(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers."""
        if len(self.table) > WORDS:  # short words are the common ones
            self.table = {w: x for w, x in self.table.items() if len(w) <= 7}
        table = self.table
        split = [self.words(t) for t in texts]
        found = [list(map(table.get, words)) for words in split]
        holes = [_holes(some) for some in found]
        missing = list({words[i] for words, here in zip(split, holes) for i in here})
        for k in range(0, len(missing), 4000):
            self._learn(missing[k : k + 4000])
        for words, some, here in zip(split, found, holes):
            for i in here:
                some[i] = table[words[i]]
        out = [b"".join(some) for some in found]
        for w in missing:
            if len(w) > 200:
                del table[w]
        return out


@cache
def _tokens(path: str) -> WordTokens:
    """A Python worker keeps its word table from task to task, until pieces are placed."""
    return WordTokens(path)


def _pieces(path: str, capacity: int, end: int):
    """Arrow function: the pieces of each document's ids."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        tokens = _tokens(path)
        close = np.array([end], "<u4").tobytes()
        for batch in batches:
            out: dict[str, list] = defaultdict(list)
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text")
            for i, key in enumerate(ids):
                if i % TEXTS == 0:
                    some = tokens.ids([t or "" for t in texts.slice(i, TEXTS).to_pylist()])
                data = some[i % TEXTS] + close
                for piece, at in enumerate(range(0, len(data), 4 * capacity)):
                    part = data[at : at + 4 * capacity]
                    out["doc_id"].append(key)
                    out["piece"].append(piece)
                    out["start"].append(at // 4)
                    out["length"].append(len(part) // 4)
                    out["ids_crc32"].append(zlib.crc32(part))
            if ids:
                yield pa.record_batch(
                    {
                        "doc_id": pa.array(out["doc_id"], pa.int64()),
                        "piece": pa.array(out["piece"], pa.int32()),
                        "start": pa.array(out["start"], pa.int64()),
                        "length": pa.array(out["length"], pa.int64()),
                        "ids_crc32": pa.array(out["ids_crc32"], pa.int64()),
                    }
                )

    return cut


def packing_plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """How pieces of each length fill sequences.

    Rows (length, first rank, end rank, first sequence, per sequence, offset): the pieces of
    that rank go ``per sequence`` each to consecutive sequences, on end from ``offset`` on.
    """
    left = {length: n for length, n in counts.items() if n}
    if any(not 0 < length <= capacity for length in left):
        raise ValueError("a piece is longer than a sequence or empty")
    used: dict[int, int] = defaultdict(int)
    plan: list[tuple[int, int, int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)  # gap: (first sequence, number)
    sequences = 0

    def put(length: int, n: int, first: int, each: int, offset: int) -> None:
        plan.append((length, used[length], used[length] + n, first, each, offset))
        used[length] += n
        left[length] -= n

    # large items: the longest with the longest partner that fits
    large = sorted((x for x in left if 3 * x > capacity), reverse=True)
    for a in large:
        while left[a]:
            fits = next((b for b in large if left[b] and a + b <= capacity), None)
            if fits is None:
                n = left[a]
                put(a, n, sequences, 1, 0)
                if capacity > a:
                    gaps[capacity - a].append((sequences, n))
            elif fits == a:
                n = left[a] // 2
                if not n:
                    smaller = next((b for b in large if b < a and left[b]), None)
                    put(a, 1, sequences, 1, 0)
                    if smaller is None:
                        gaps[capacity - a].append((sequences, 1))
                    else:
                        put(smaller, 1, sequences, 1, a)
                        if capacity > a + smaller:
                            gaps[capacity - a - smaller].append((sequences, 1))
                    sequences += 1
                    continue
                put(a, 2 * n, sequences, 2, 0)
                if capacity > 2 * a:
                    gaps[capacity - 2 * a].append((sequences, n))
            else:
                n = min(left[a], left[fits])
                put(a, n, sequences, 1, 0)
                put(fits, n, sequences, 1, a)
                if capacity > a + fits:
                    gaps[capacity - a - fits].append((sequences, n))
            sequences += n

    # small items: the smallest gap that is large enough, else new sequences
    widths = sorted(gaps)

    def leave(gap: int, first: int, n: int) -> None:
        if gap and n:
            if not gaps[gap]:
                at = bisect_left(widths, gap)
                if at == len(widths) or widths[at] != gap:
                    insort(widths, gap)
            gaps[gap].append((first, n))

    for length in sorted((x for x in left if 3 * x <= capacity), reverse=True):
        while left[length]:
            at = bisect_left(widths, length)
            if at < len(widths):
                gap = widths[at]
                first, n = gaps[gap].pop()
                if not gaps[gap]:
                    del widths[at]
                each = gap // length
            else:
                gap, each = capacity, capacity // length
                first, n = sequences, -(-left[length] // each)
                sequences += n
            full = min(n, left[length] // each)
            if full:
                put(length, full * each, first, each, capacity - gap)
                leave(gap - each * length, first, full)
                leave(gap, first + full, n - full)
            else:
                few = left[length]
                put(length, few, first, few, capacity - gap)
                leave(gap - few * length, first, 1)
                leave(gap, first + 1, n - 1)
    return plan


def _placer(plan: list[tuple[int, int, int, int, int, int]]):
    """Arrow function: sequence and offset of each piece by length and rank."""
    table = np.array(sorted(plan), np.int64).reshape(-1, 6)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _tokens.cache_clear()
        give_back()
        lengths = table[:, 0]
        bounds = {int(x): np.searchsorted(lengths, [x, x + 1]) for x in np.unique(lengths)}
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            row = np.empty(len(length), np.int64)
            for x in np.unique(length).tolist():
                lo, hi = bounds[x]
                here = length == x
                row[here] = lo + np.searchsorted(table[lo:hi, 1], rank[here], side="right") - 1
            k = rank - table[row, 1]
            each = table[row, 4]
            yield pa.record_batch(
                {
                    **{c: batch.column(c) for c in batch.schema.names if c != "rank"},
                    "sequence_id": table[row, 3] + k // each,
                    "offset": table[row, 5] + k % each * length,
                }
            )

    return place


def pack(docs: DataFrame, tokenizer: str, capacity: int = 4096, end: int = 1) -> DataFrame:
    """Documents as pieces placed in sequences of at most ``capacity`` tokens.

    A document is its token ids and ``end``; only longer ones are cut, every ``capacity``
    tokens. Returns doc_id, piece, start, length, ids_crc32, sequence_id, offset; the pieces of
    a sequence lie without gaps from offset 0. Every row is a document of its own, also with a
    repeated or missing doc_id; a missing text is empty and becomes the one token ``end``. Other
    columns of ``docs`` play no role; an empty table gives an empty result.

    The driver sees one number per length. Which of the equally long pieces goes where follows
    from a hash of the document and is the same in every run.
    """
    pieces = store(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
            _pieces(tokenizer, capacity, end),
            "doc_id long, piece int, start long, length long, ids_crc32 long",
        ),
        batch_bytes=BATCH_BYTES,
    ).withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(SALTS)))
    groups = store(pieces.groupBy("length", "salt").agg(F.count("*").alias("n")))
    # at most ``capacity`` rows
    counts = {r.length: r.n for r in groups.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = packing_plan(counts, capacity)
    before = Window.partitionBy("length").orderBy("salt")
    bases = groups.select(
        "length", "salt", (F.sum("n").over(before) - F.col("n")).alias("base")
    )
    inside = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (
        pieces.withColumn("within", F.row_number().over(inside) - 1)
        .join(bases, ["length", "salt"])
        .select(
            "doc_id", "piece", "start", "length", "ids_crc32",
            (F.col("base") + F.col("within")).cast("long").alias("rank"),
        )
    )
    return ranked.mapInArrow(
        _placer(plan),
        "doc_id long, piece int, start long, length long, ids_crc32 long, "
        "sequence_id long, offset long",
    )
