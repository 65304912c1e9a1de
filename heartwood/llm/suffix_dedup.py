"""Removal of long byte strings that occur more than once, by merged Burrows-Wheeler transforms.

A window is a string of ``window`` bytes. All windows of the corpus have to be compared, and
equal ones have to meet in one task without sending every suffix around:

1. Each window is named by the smallest hash of the short strings (grams) in it. Equal windows
   have equal names, and neighbouring windows mostly share theirs, so a text falls into runs
   of some 85 windows with one name. Only names and places are shuffled. A run whose name
   occurs nowhere else holds no repeated window.
2. The bytes under the other runs (spans) are dealt to tasks by name. Equal spans, as copies
   of a text have them, become one with a weight. All windows of a span that stands for
   copies are repeated, so it is merged only if a different span has its name too.
3. In a task, windows are hashed first. A window whose hash is met once is not repeated; of the
   bytes under the others, pieces that are copies of each other become one with a weight, and
   only pieces that stand alone are merged, with those that share a hash with them.
   Spans are dealt to shards. Each shard's suffixes are sorted once; that gives the
   shard's Burrows-Wheeler transform. The transforms are merged by refining their interleave:
   it is first right for suffixes as compared by no byte, and each round sorts it stably by
   the symbol before each suffix, which makes it right for ``step`` more bytes. Rows that
   part in a round have their common prefix there; rows still together after ``window`` bytes
   are a repeated interval. A row alone in its interval is done and leaves the merge.
4. The removed ranges of each text are joined back to the rows that hold it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heartwood.llm.common import give_back, mix, text_buffers, text_id
from heartwood.llm.words import byte_values, powers

GRAM = 32
TILE = 1 << 17
#: bytes of different spans that are merged at once, if their names allow it
CHUNK = 1 << 16
#: symbols of a round: as many bytes as keep the number of different symbols within 16 bits
STEPS = (8, 5, 4, 2, 1)

_VALUES = byte_values()


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each GRAM bytes on end."""
    h = mix((data.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
    width = 1
    while width < GRAM:
        h = h[:-width] * np.uint64(0x2545F4914F6CDD1D + 2 * width) + h[width:]
        width *= 2
    return mix(h)


def _window_names(data: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window of ``data`` the smallest hash of the grams in it, and whether the gram
    it begins with has that hash."""
    hashes = low = _gram_hashes(data)
    need, have = window - GRAM + 1, 1
    while have * 2 <= need:
        low = np.minimum(low[:-have], low[have:])
        have *= 2
    rest = need - have
    if rest:
        low = np.minimum(low[: len(low) - rest], low[rest:])
    return low, hashes[: len(low)] == low


def _runs(window: int):
    """Arrow function: the runs of all texts, and how many rows of the batch hold each text."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a = batch.column("text_a").to_numpy()
            b = batch.column("text_b").to_numpy()
            _, first, copies = np.unique(
                np.stack([a, b]), axis=1, return_index=True, return_counts=True
            )
            data, offsets = text_buffers(batch.column("text").take(pa.array(first)))
            a, b = a[first], b[first]
            for begin in range(0, max(0, len(data) - window + 1), TILE):
                piece = data[begin : begin + TILE + window - 1]
                names, leads = _window_names(piece, window)
                starts = np.arange(begin, begin + len(names))
                row = np.searchsorted(offsets, starts, side="right") - 1
                inside = starts + window <= offsets[row + 1]
                names, leads, starts, row = (
                    x[inside] for x in (names, leads, starts, row)
                )
                if not len(names):
                    continue
                new = np.ones(len(names), bool)
                new[1:] = (names[1:] != names[:-1]) | (row[1:] != row[:-1])
                at = np.flatnonzero(new)
                # a run that goes on after the gram it is named by has left may repeat itself
                leads[:-1] &= ~new[1:]
                leads[-1] = False
                folds = np.logical_or.reduceat(leads, at)
                row = row[at]
                yield pa.record_batch(
                    {
                        "name": names[at].view(np.int64),
                        "text_a": a[row],
                        "text_b": b[row],
                        "start": (starts[at] - offsets[row]).astype(np.int32),
                        "n": np.diff(np.append(at, len(names))).astype(np.int32),
                        "copies": copies[row].astype(np.int32),
                        "uses": (copies[row] + folds).astype(np.int32),
                    }
                )

    return scan


def _spans(window: int):
    """Arrow function: the bytes under the marked runs, once for rows on end with one text."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            a = batch.column("text_a").to_numpy()
            b = batch.column("text_b").to_numpy()
            texts, marks = batch.column("text"), batch.column("marks")
            for i in range(batch.num_rows):
                if last == (a[i], b[i]):
                    continue
                last = (a[i], b[i])
                data = texts[i].as_buffer()
                runs = marks[i].values.flatten()
                name, start, n, copies = (x.to_numpy(zero_copy_only=False) for x in runs)
                for j in range(0, len(name), 2000):
                    k = slice(j, j + 2000)
                    yield pa.record_batch(
                        {
                            "name": name[k],
                            "text_a": np.full(len(name[k]), a[i]),
                            "text_b": np.full(len(name[k]), b[i]),
                            "start": start[k],
                            "copies": copies[k],
                            "span": pa.array(
                                [
                                    data.slice(s, m + window - 1).to_pybytes()
                                    for s, m in zip(start[k].tolist(), n[k].tolist())
                                ],
                                pa.binary(),
                            ),
                        }
                    )

    return cut


def _dense(*keys: np.ndarray) -> np.ndarray:
    """Ranks from 0 of the rows of ``keys``, each a non-negative number below 2**32."""
    key = keys[0].astype(np.uint64)
    for other in keys[1:]:
        key = key << np.uint64(32) | other.astype(np.uint64)
    return _ranks(key)


def _ranks(key: np.ndarray) -> np.ndarray:
    order = np.argsort(key)
    got = key[order]
    new = np.empty(len(key), np.int32)
    new[:1] = 0
    np.cumsum(got[1:] != got[:-1], out=new[1:])
    ranks = np.empty(len(key), np.int32)
    ranks[order] = new
    return ranks


def _eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one number, zero beyond the end."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    value = padded[: len(data)].copy()
    for k in range(1, 8):
        value <<= np.uint64(8)
        value |= padded[k : len(data) + k]
    return value


def shard_order(data: np.ndarray, shard: np.ndarray, depth: int) -> np.ndarray:
    """Places sorted by shard and then by the ``depth`` bytes from there on: each shard's
    suffix array. The first pass compares eight bytes, each further one doubles that, for
    those places only that are still tied."""
    n = len(data)
    rank = _dense(shard, _ranks(_eights(data)))
    width = 8
    while width < depth:
        times = np.bincount(rank)
        if len(times) == n:
            break
        # ranks as places in the order, so that ties can be ordered on their own
        place = (np.cumsum(times) - times).astype(np.int32)[rank]
        tied = np.flatnonzero(times[rank] > 1)
        ahead = np.zeros(len(tied), np.int64)
        inside = tied + width < n
        ahead[inside] = place[tied[inside] + width] + 1
        order = np.lexsort((ahead, place[tied]))
        p, q = place[tied[order]], ahead[order]
        same = np.zeros(len(tied), bool)
        same[1:] = (p[1:] == p[:-1]) & (q[1:] == q[:-1])
        group = np.flatnonzero(np.r_[True, p[1:] != p[:-1]])
        within = np.arange(len(tied)) - np.repeat(group, np.diff(np.r_[group, len(tied)]))
        value = np.where(same, 0, p + within)
        np.maximum.accumulate(value, out=value)
        refined = place.copy()
        refined[tied[order]] = value
        rank = _ranks(refined.astype(np.uint64))
        width *= 2
    return np.argsort(rank, kind="stable").astype(np.int32)


def _interleaved(
    spans: list[bytes], weights: np.ndarray, shard: np.ndarray, window: int
) -> tuple[np.ndarray, np.ndarray]:
    """``merged_intervals`` by the merge of all suffixes."""
    # one byte after each span, so that its end is a place too: the empty suffix
    lengths = np.array([len(s) for s in spans]) + 1
    data = np.frombuffer(b"\0".join(spans) + b"\0", np.uint8)
    n = len(data)
    owner = np.repeat(np.arange(len(spans), dtype=np.int32), lengths)
    room = ((np.cumsum(lengths) - 1)[owner] - np.arange(n)).astype(np.int32)  # to the span's end
    repeated, common = np.zeros(n, bool), np.zeros(n, np.int32)

    # shard transforms: rows are places in shard order; before[] leads from a row to the row of
    # the place ``step`` earlier, symbol[] is what stands in between (the BWT of that alphabet)
    order = shard_order(data, shard[owner], window)
    eights = _eights(data)
    for step in STEPS:
        if window % step:
            continue
        symbols = _ranks(eights >> np.uint64(8 * (8 - step)))
        if step == STEPS[-1] or int(symbols.max(initial=0)) < 1 << 16:
            break
    symbols = symbols.astype(np.uint16)
    row_of = np.empty(n, np.int32)
    row_of[order] = np.arange(n, dtype=np.int32)
    has = order >= step
    has &= owner[order] == owner[order - step]
    before = np.where(has, row_of[order - step], -1)
    symbol = np.where(has, symbols[order - step], 0).astype(np.uint16)
    weight = np.minimum(weights, 2)[owner[order]]

    # the interleave: rows of all shards, sorted by the first h bytes; block: equal so far
    rows = np.arange(n, dtype=np.int32)
    block = np.zeros(n, np.int32)
    for h in range(0, window, step):
        before_rows = before[rows]
        keep = before_rows >= 0
        rows, block, before_rows = rows[keep], block[keep], before_rows[keep]
        by = np.argsort(symbol[rows], kind="stable")
        sym, old, rows = symbol[rows[by]], block[by], before_rows[by]
        if not len(rows):
            break
        new = np.empty(len(rows), bool)
        new[0] = True
        np.logical_or(sym[1:] != sym[:-1], old[1:] != old[:-1], out=new[1:])
        heads = np.flatnonzero(new)
        times = np.diff(np.append(heads, len(rows)))
        block = np.cumsum(new, dtype=np.int32) - 1
        alone = (times == 1)[block]
        places = order[rows]
        common[places[~alone]] = h + step
        # alone: done, and so are all places before it in the span; its window is repeated
        # only if the span stands for copies
        rows, block = rows[~alone], block[~alone]
    repeated[order[rows]] = True
    copied = (weights >= 2)[owner] & (room >= window)
    return repeated | copied, common


def _window_hashes(data: np.ndarray, starts: np.ndarray, window: int) -> np.ndarray:
    """A 64-bit hash of the ``window`` bytes from each of ``starts`` (in order) on."""
    out = np.empty(len(starts), np.uint64)
    up, down = powers(TILE + window)
    total = np.zeros(TILE + window + 1, np.uint64)
    for begin in range(0, len(data), TILE):
        piece = data[begin : begin + TILE + window]
        np.cumsum(_VALUES[piece] * up[: len(piece)], out=total[1 : len(piece) + 1])
        lo, hi = np.searchsorted(starts, [begin, begin + TILE])
        at = starts[lo:hi] - begin
        out[lo:hi] = (total[at + window] - total[at]) * down[at]
    return out


def _met_twice(hashes: np.ndarray) -> np.ndarray:
    """Which hashes occur more than once."""
    order = np.argsort(hashes)
    same = np.diff(hashes[order]) == 0
    out = np.zeros(len(hashes), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def _pieces(hashes: np.ndarray, starts: np.ndarray, window: int, size: int) -> np.ndarray:
    """Where among windows (places in order) the pieces begin that windows on end make up: each is
    cut where a copy of that window begins or ends one, unless that makes the pieces too long."""
    new = np.r_[True, np.diff(starts) != 1]
    ends = np.append(new[1:], True)
    cut = new | np.isin(hashes, hashes[new])
    cut[1:] |= np.isin(hashes[:-1], hashes[ends])
    return np.flatnonzero(cut if np.count_nonzero(cut) * window <= 16 * size else new)


def _repeated(
    spans: list[bytes], weights: np.ndarray, shard: np.ndarray, window: int
) -> np.ndarray:
    """The marks of ``merged_intervals``, by a merge of those bytes only that need one.

    Equal windows have equal hashes, so a window whose hash is met once is not repeated. The others
    make up pieces, most of which are copies of each other and become one with a weight; its
    windows are repeated. Pieces that stand alone are merged with those they share a hash with.
    """
    lengths = np.array([len(s) for s in spans])
    offsets = np.cumsum(lengths + 1) - lengths - 1
    joined = b"\0".join(spans) + b"\0"
    data = np.frombuffer(joined, np.uint8)
    marks = np.zeros(len(data), bool)
    n = np.maximum(lengths - window + 1, 0)
    owner = np.repeat(np.arange(len(spans)), n)
    starts = np.arange(len(owner)) + np.repeat(offsets - np.cumsum(n) + n, n)
    hashes = _window_hashes(data, starts, window)
    may = _met_twice(hashes) | (weights >= 2)[owner]
    starts, owner, hashes = starts[may], owner[may], hashes[may]
    if not len(starts):
        return marks
    first = _pieces(hashes, starts, window, len(data))
    stop = np.append(first[1:], len(starts))
    number: dict[bytes, int] = {}
    piece = np.array(
        [
            number.setdefault(joined[a : b + window], len(number))
            for a, b in zip(starts[first].tolist(), starts[stop - 1].tolist())
        ]
    )
    weight = np.bincount(piece, weights[owner[first]], len(number)).astype(np.int64)
    of = np.repeat(piece, stop - first)
    alone = (weight == 1)[of]
    marks[starts[~alone]] = True
    if not alone.any():
        return marks
    merged = np.unique(of[np.isin(hashes, hashes[alone])])
    shown = first[np.unique(piece, return_index=True)[1][merged]]
    texts = list(number)
    texts = [texts[k] for k in merged.tolist()]
    found, _ = _interleaved(texts, weight[merged], shard[owner[shown]], window)
    at = 0
    for place, text in zip(starts[shown].tolist(), texts):
        windows = len(text) - window + 1
        marks[place : place + windows] |= found[at : at + windows]
        at += len(text) + 1
    return marks


def merged_intervals(
    spans: list[bytes],
    weights: np.ndarray,
    shard: np.ndarray,
    window: int,
    prefixes: bool = True,
) -> tuple[np.ndarray, np.ndarray | None]:
    """Which places of the spans on end begin a window that occurs twice, weights counted.

    Returns that mark for each place, and the length of the prefix (in whole rounds) that a
    place shares with another one, ``window`` at most; without ``prefixes`` None.
    """
    if prefixes:
        return _interleaved(spans, weights, shard, window)
    return _repeated(spans, weights, shard, window), None


def _merge(window: int):
    """Arrow function on rows sorted by name and span: the ranges of removed bytes."""

    def flush(spans, weights, members, shards=8):
        n = len(spans)
        marks, _ = merged_intervals(
            spans, np.array(weights), np.arange(n, dtype=np.int32) % shards, window, False
        )
        found, at = [], 0
        for span, held in zip(spans, members):
            mark = marks[at : at + len(span) - window + 1]
            at += len(span) + 1
            if not mark.any():
                continue
            edge = np.flatnonzero(np.diff(np.r_[0, mark.view(np.int8), 0]))
            for a, b, start in held:
                for lo, hi in edge.reshape(-1, 2).tolist():
                    found.append((a, b, start + lo, start + hi + window - 1))
        return found

    def ranges(found):
        a, b, lo, hi = zip(*found) if found else ((), (), (), ())
        return pa.record_batch(
            {
                "text_a": pa.array(a, pa.int64()),
                "text_b": pa.array(b, pa.int64()),
                "lo": pa.array(lo, pa.int32()),
                "hi": pa.array(hi, pa.int32()),
            }
        )

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans: list[bytes] = []
        weights: list[int] = []
        members: list[list[tuple]] = []
        whole: list[tuple] = []  # ranges of spans that are repeated as a whole
        size, first, last = 0, 0, None  # first: where the spans of the last name begin

        def settle():
            """Take the spans of a name that is complete out if it is one span of copies."""
            if len(spans) == first + 1 and weights[first] >= 2:
                length = len(spans[first])
                whole.extend((a, b, start, start + length) for a, b, start in members[first])
                del spans[first], weights[first], members[first]
                return length
            return 0

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in
                       ("name", "span", "text_a", "text_b", "start", "copies")]
            for name, span, a, b, start, copies in zip(*columns):
                if name != last:
                    size -= settle()
                    if size >= CHUNK:
                        yield ranges(flush(spans, weights, members))
                        spans, weights, members, size = [], [], [], 0
                    if len(whole) >= 10_000:
                        yield ranges(whole)
                        whole = []
                    first, last = len(spans), name
                elif span == spans[-1]:
                    weights[-1] += copies
                    members[-1].append((a, b, start))
                    continue
                spans.append(span)
                weights.append(copies)
                members.append([(a, b, start)])
                size += len(span)
        settle()
        if spans:
            yield ranges(flush(spans, weights, members))
        if whole:
            yield ranges(whole)
        del spans, weights, members, whole
        give_back()

    return merge


def _apply(as_text: bool):
    """Arrow function: the rows of documents without the removed ranges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _cut(batch, as_text)

    return run


def _cut(batch: pa.RecordBatch, as_text: bool) -> pa.RecordBatch:
    n_bytes, n_removed, n_spans, kept = [], [], [], []
    for text, ranges in zip(batch.column("text"), batch.column("ranges")):
        data = text.as_buffer().to_pybytes() if text.is_valid else b""
        joined: list[list[int]] = []
        for r in sorted((r["lo"], r["hi"]) for r in ranges.as_py() or ()):
            if joined and r[0] <= joined[-1][1]:
                joined[-1][1] = max(joined[-1][1], r[1])
            else:
                joined.append(list(r))
        parts, at = [], 0
        for lo, hi in joined:
            parts.append(data[at:lo])
            at = hi
        parts.append(data[at:])
        if as_text:
            parts = [p.decode("utf-8", "ignore").encode() for p in parts]
        n_bytes.append(len(data))
        n_removed.append(sum(hi - lo for lo, hi in joined))
        n_spans.append(len(joined))
        kept.append(b"".join(parts))
    rest = [c for c in batch.schema.names if c not in ("text_a", "text_b", "text", "ranges")]
    return pa.record_batch(
        {
            **{c: batch.column(c) for c in rest},
            "n_bytes": pa.array(n_bytes, pa.int64()),
            "n_removed": pa.array(n_removed, pa.int64()),
            "n_spans": pa.array(n_spans, pa.int64()),
            "kept": pa.array(kept, pa.binary()).cast(pa.string() if as_text else pa.binary()),
        }
    )


def repeated_ranges(docs: DataFrame, window: int = 200) -> DataFrame:
    """Byte ranges [lo, hi) of each text covered by strings of ``window`` bytes that also start
    elsewhere in the corpus: rows (text_a, text_b, lo, hi), possibly overlapping.

    ``docs`` has text, text_a and text_b. Work is bounded per task by the spans that share one
    name; a text that many rows hold counts its rows and is cut and merged once.
    """
    if window < GRAM:
        raise ValueError(f"window has to be at least {GRAM}")
    runs = docs.mapInArrow(
        _runs(window),
        "name long, text_a long, text_b long, start int, n int, copies int, uses int",
    )
    shared = (
        runs.withColumn("total", F.expr("sum(uses) over (partition by name)"))
        .where("total >= 2")
        .groupBy("text_a", "text_b", "name", "start", "n")
        .agg(F.sum("copies").cast("int").alias("copies"))
        .groupBy("text_a", "text_b")
        .agg(F.collect_list(F.struct("name", "start", "n", "copies")).alias("marks"))
    )
    spans = docs.join(shared, ["text_a", "text_b"]).mapInArrow(
        _spans(window),
        "name long, text_a long, text_b long, start int, copies int, span binary",
    )
    return (
        spans.repartition("name")
        .sortWithinPartitions("name", "span")
        .mapInArrow(_merge(window), "text_a long, text_b long, lo int, hi int")
    )


def remove_repeats(
    docs: DataFrame,
    window: int = 200,
    carry: tuple[str, ...] = ("doc_id",),
    as_text: bool = False,
) -> DataFrame:
    """Each row of ``docs`` without the bytes that ``window``-byte strings repeat.

    Returns the ``carry`` columns, n_bytes, n_removed, n_spans (maximal removed runs) and kept
    (binary: the remaining bytes; a cut may fall inside a character; with ``as_text`` a string,
    from which the bytes of such characters are gone). Strings are judged on the input, overlaps count, and both places of a string lose it. Rows, not ids, are
    documents: two rows with one text repeat each other. A missing text is empty; texts
    shorter than ``window`` stay whole; an empty table gives an empty result.
    """
    named = docs.select(
        *[F.col(c).alias(f"carry_{c}") for c in carry],
        F.coalesce("text", F.lit("")).alias("text"),
        *text_id(F.col("text")),
    )
    removed = (
        repeated_ranges(named, window)  # all columns: both joins share one shuffle of the rows
        .groupBy("text_a", "text_b")
        .agg(F.collect_set(F.struct("lo", "hi")).alias("ranges"))
    )
    fields = [named.schema[f"carry_{c}"] for c in carry]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    return (
        named.join(removed, ["text_a", "text_b"], "left")
        .mapInArrow(
            _apply(as_text),
            f"{schema}, n_bytes long, n_removed long, n_spans long, "
            f"kept {'string' if as_text else 'binary'}",
        )
        .withColumnsRenamed({f"carry_{c}": c for c in carry})
    )
