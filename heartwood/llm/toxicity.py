"""Toxicity by a factorization machine over hashed terms.

Terms are the words of a text and their prefixes, hashed. Training takes a bounded sample of the
labelled rows of either label, so that labels can be broadcast and no text is shuffled. A
chi-squared test on document counts says which terms matter, and the machine learns all of those.
It has a weight and a short vector per term: the score of a text is the sum of the weights of its
terms plus the products of the vectors of every two of them, so that an insult next to a group name
can count more than both alone.

Words that tell only together with others are neutral in that test. So it is repeated among the
rows that the machine takes for clean and among those it takes for toxic, and what tells there is
learnt as well, until nothing is added. Words that stay neutral even there, as in a pure parity of
several words, are not known.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heartwood.llm.common import give_back, row_blocks, store, text_buffers
from heartwood.llm.words import letter_words, word_hashes

#: hash buckets of terms
BUCKETS = 1 << 22
#: words are also taken by their first bytes
PREFIXES = (4, 5, 6)
#: a chi-squared statistic below this is no evidence among millions of buckets
CHI = 25.0
#: rows of the label a term speaks for that hold it, at least
EVIDENCE = 3
#: the test is repeated among the rows of either prediction at most so often
REPEATS = 4
#: labelled rows the machine is trained on, at most so many of each label
SAMPLE = 15_000
BLOCK = 1 << 19
#: where in the gap between clean and toxic training scores one half lies
GAP = 0.18


@dataclass(frozen=True)
class Machine:
    """A trained machine: known buckets in order, weights, vectors and the constant."""

    buckets: np.ndarray
    weights: np.ndarray
    vectors: np.ndarray
    constant: float

    def scores(self, terms: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
        """Probabilities of ``n`` texts from their distinct known terms (places in buckets)."""
        z = np.full(n, self.constant)
        if len(terms):
            np.add.at(z, owner, self.weights[terms])
            total = np.zeros((n, self.vectors.shape[1]))
            square = np.zeros(n)
            np.add.at(total, owner, self.vectors[terms])
            np.add.at(square, owner, (self.vectors[terms] ** 2).sum(axis=1))
            z += 0.5 * ((total**2).sum(axis=1) - square)
        return 1 / (1 + np.exp(-np.clip(z, -700, 40)))


def text_terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct term buckets of texts that lie on end, with the text of each."""
    hashes, owner = word_hashes(data, offsets, letter_words(), PREFIXES)
    key = np.concatenate([(h & np.uint64(BUCKETS - 1)).view(np.int64) for h in hashes])
    key = np.unique(np.tile(owner, len(hashes)) * BUCKETS + key)
    return key % BUCKETS, key // BUCKETS


class _Places:
    """Places of buckets in an ordered list: a bit for each bucket there is, and how many are listed
    before each 64 of them."""

    def __init__(self, buckets: np.ndarray):
        self.buckets = buckets
        self.bits = np.zeros(BUCKETS // 64, np.uint64)
        np.bitwise_or.at(self.bits, buckets >> 6, _bit(buckets))
        counts = np.bitwise_count(self.bits).astype(np.int32)
        self.before = np.cumsum(counts, dtype=np.int32) - counts

    def find(self, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of ``some`` buckets are in the list, and the places of those."""
        has = (self.bits[some >> 6] & _bit(some)) != 0
        some = some[has]
        low = np.bitwise_count(self.bits[some >> 6] & (_bit(some) - np.uint64(1)))
        return has, self.before[some >> 6] + low.astype(np.int64)


def _bit(bucket: np.ndarray) -> np.ndarray:
    return np.uint64(1) << (bucket & 63).astype(np.uint64)


def _known_terms(
    data: np.ndarray, offsets: np.ndarray, places: _Places
) -> tuple[np.ndarray, np.ndarray]:
    """As ``text_terms``, for known buckets only; terms as places among them."""
    hashes, owner = word_hashes(data, offsets, letter_words(), PREFIXES)
    n = np.int64(max(len(places.buckets), 1))
    found = []
    for h in hashes:
        has, at = places.find((h & np.uint64(BUCKETS - 1)).view(np.int64))
        found.append(owner[has] * n + at)
    key = np.unique(np.concatenate(found))
    return key % n, key // n


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys in order, each with the sum of its counts."""
    key, at = np.unique(np.concatenate(keys), return_inverse=True)
    return key, np.bincount(at, np.concatenate(counts), len(key)).astype(np.int64)


def _term_rows(machine: Machine | None):
    """Arrow function: document counts of term buckets by label, among the rows the machine takes
    for clean (part 0; without a machine all rows) and for toxic (part 1), summed over the
    partition; bucket -1 counts the rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = 1 if machine is None else 2
        totals = np.zeros(2 * parts, np.int64)
        places = None if machine is None else _Places(machine.buckets)
        # key: bucket, part and label in one number; sums of blocks wait until they are as many as
        # the sum so far, so that each is added up few times
        keys, counts, held = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
        for batch in batches:
            label = batch.column("toxic").to_numpy()
            data, offsets = text_buffers(batch.column("text"))
            for lo, hi in row_blocks(offsets, BLOCK):
                piece = data[offsets[lo] : offsets[hi]]
                terms, owner = text_terms(piece, offsets[lo : hi + 1] - offsets[lo])
                kind = label[lo:hi].astype(np.int64)
                if places is not None:
                    has, at = places.find(terms)
                    kind += 2 * (machine.scores(at, owner[has], hi - lo) >= 0.5)
                key, n = np.unique(terms * 4 + kind[owner], return_counts=True)
                keys.append(key)
                counts.append(n)
                held += len(key)
                if held > max(len(keys[0]), 200_000):
                    key, n = _summed(keys, counts)
                    keys, counts, held = [key], [n], 0
                totals += np.bincount(kind, minlength=2 * parts)
        key, n = _summed(keys, counts)
        del keys, counts
        for part in range(parts):
            yield pa.record_batch(
                {
                    "part": np.array([part], np.int32),
                    "bucket": np.array([-1]),
                    "clean": totals[2 * part : 2 * part + 1],
                    "toxic": totals[2 * part + 1 : 2 * part + 2],
                }
            )
        for k in range(0, len(key), 100_000):
            some, times = key[k : k + 100_000], n[k : k + 100_000]
            toxic = some % 2 == 1
            yield pa.record_batch(
                {
                    "part": (some % 4 // 2).astype(np.int32),
                    "bucket": some // 4,
                    "clean": np.where(toxic, 0, times),
                    "toxic": np.where(toxic, times, 0),
                }
            )
        del key, n, places
        give_back()

    return run


def _telling(rows: DataFrame, machine: Machine | None) -> np.ndarray:
    """Buckets whose document counts differ between the labels, among all rows or among those of
    either prediction of the machine."""
    counts = store(
        rows.mapInArrow(_term_rows(machine), "part int, bucket long, clean long, toxic long")
        .groupBy("part", "bucket")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    )
    found = [np.zeros(0, np.int64)]
    for total in counts.where("bucket = -1").collect():
        pos, neg = float(total.toxic), float(total.clean)
        if not pos or not neg:
            continue
        a, b = F.col("toxic").cast("double"), F.col("clean").cast("double")
        absent_a, absent_b = F.lit(pos) - a, F.lit(neg) - b
        chi = (
            (a * absent_b - b * absent_a) ** 2
            * (pos + neg)
            / (pos * neg * (a + b) * (absent_a + absent_b + 1e-9))
        )
        evidence = F.when(a * neg > b * pos, a).otherwise(b)
        known = counts.where(
            (F.col("bucket") >= 0) & (F.col("part") == total.part)
            & (evidence >= EVIDENCE) & (chi >= CHI)
        )
        found.append(np.array([r.bucket for r in known.select("bucket").collect()], np.int64))
    return np.unique(np.concatenate(found))


def _sample_rows(buckets: np.ndarray):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = _Places(buckets)
        for batch in batches:
            data, offsets = text_buffers(batch.column("text"))
            for lo, hi in row_blocks(offsets, BLOCK):
                piece = data[offsets[lo] : offsets[hi]]
                terms, owner = _known_terms(piece, offsets[lo : hi + 1] - offsets[lo], places)
                first = np.searchsorted(owner, np.arange(hi - lo + 1))
                yield pa.record_batch(
                    {
                        "toxic": batch.column("toxic").slice(lo, hi - lo),
                        "terms": pa.ListArray.from_arrays(
                            pa.array(first, pa.int32()), pa.array(terms, pa.int32())
                        ),
                    }
                )
        del places
        give_back()

    return rows


def _fit(
    buckets: np.ndarray,
    terms: np.ndarray,
    owner: np.ndarray,
    label: np.ndarray,
    factors: int = 4,
    rounds: int = 150,
    rate: float = 0.3,
    decay: float = 1e-6,
) -> Machine:
    """Logistic loss over all sample rows at once, both labels with equal weight, by Adagrad."""
    n, m = len(label), len(buckets)
    random = np.random.default_rng(7)
    w, v, constant = np.zeros(m), random.normal(0, 0.01, (m, factors)), 0.0
    gw, gv, gc = np.full(m, 1e-8), np.full((m, factors), 1e-8), 1e-8
    weight = np.where(label == 1, 0.5 / max(label.sum(), 1), 0.5 / max((1 - label).sum(), 1))
    terms, owner = terms.astype(np.int64), owner.astype(np.int64)
    order = np.argsort(terms, kind="stable")
    by_term, rows = terms[order], owner[order]
    heads = np.flatnonzero(np.r_[True, by_term[1:] != by_term[:-1]])[: len(by_term)]
    known = by_term[heads]
    has = np.bincount(owner, minlength=n) > 0
    first = np.searchsorted(owner, np.flatnonzero(has))
    del order, by_term
    at_terms = np.empty(len(terms))

    def summed(x: np.ndarray, at: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """Sums of x[at] over the ranges from each of ``begins`` on."""
        return np.add.reduceat(np.take(x, at, out=at_terms, mode="clip"), begins)

    for _ in range(rounds):
        total, square, z = np.zeros((factors, n)), np.zeros(n), np.full(n, constant)
        if len(terms):
            for f in range(factors):
                total[f, has] = summed(np.ascontiguousarray(v[:, f]), terms, first)
            square[has] = summed((v**2).sum(axis=1), terms, first)
            z[has] += summed(w, terms, first)
        z += 0.5 * ((total**2).sum(axis=0) - square)
        error = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - label) * weight
        dc = error.sum()
        gc += dc**2
        constant -= rate * dc / np.sqrt(gc)
        if not len(terms):
            continue
        dw = np.zeros(m)
        dw[known] = summed(error, rows, heads)
        dv = np.zeros((m, factors))
        for f in range(factors):
            dv[known, f] = summed(error * total[f], rows, heads)
        dv -= v * dw[:, None]
        dw += decay * w
        dv += decay * v
        gw += dw**2
        gv += dv**2
        w -= rate * dw / np.sqrt(gw)
        v -= rate * dv / np.sqrt(gv)
    # one half is put into the gap between the labels, nearer to the clean rows: a toxic text with
    # rare words scores lower than those learnt from, while nothing lifts a clean one
    low, high = np.quantile(z[label == 0], 0.999), np.quantile(z[label == 1], 0.01)
    if high > low:
        constant -= low + GAP * (high - low)
    return Machine(buckets, w, v, constant)


def train(labelled: DataFrame) -> Machine:
    """A machine from rows (text, toxic); rows without a 0 or 1 in toxic are passed over.

    ``labelled`` is of bounded size, see ``labelled_rows``. Every term is known whose document
    counts have a chi-squared statistic of ``CHI`` or more, among all rows or among the rows of
    one prediction of the machine fitted before. Without rows of both labels nothing is learnt
    and every score is 0; without a telling term every score is the share of toxic rows.
    """
    rows = labelled.where("toxic in (0, 1)").select(
        F.coalesce("text", F.lit("")).alias("text"), F.col("toxic").cast("int").alias("toxic")
    )
    sums = {r.toxic: r.n for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    empty = np.zeros(0, np.int64)
    if len(sums) < 2:
        return Machine(empty, np.zeros(0), np.zeros((0, 1)), -np.inf)
    buckets = _telling(rows, None)
    if not len(buckets):
        return Machine(empty, np.zeros(0), np.zeros((0, 1)), float(np.log(sums[1] / sums[0])))
    machine = _learnt(rows, buckets)
    for _ in range(REPEATS):
        more = np.union1d(buckets, _telling(rows, machine))
        if len(more) == len(buckets):
            break
        buckets = more
        machine = _learnt(rows, buckets)
    return machine


def _learnt(rows: DataFrame, buckets: np.ndarray) -> Machine:
    got = rows.mapInArrow(_sample_rows(buckets), "toxic int, terms array<int>").toArrow()
    lists = got.column("terms").combine_chunks()
    label = got.column("toxic").to_numpy().astype(float)
    owner = np.repeat(np.arange(len(label)), np.diff(lists.offsets.to_numpy()))
    return _fit(buckets, lists.flatten().to_numpy(), owner, label)


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """``docs`` with toxicity (0 to 1) of the whole text; a missing text scores as an empty one.

    All columns stay; a column of the name toxicity is replaced. An empty table stays empty.
    """
    rest = [c for c in docs.columns if c != "toxicity"]
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in rest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = _Places(machine.buckets)
        for batch in batches:
            data, offsets = text_buffers(batch.column("text"))
            for lo, hi in row_blocks(offsets, BLOCK):
                piece = data[offsets[lo] : offsets[hi]]
                terms, owner = _known_terms(piece, offsets[lo : hi + 1] - offsets[lo], places)
                rows = batch.slice(lo, hi - lo)
                yield pa.record_batch(
                    {
                        **{c: rows.column(c) for c in rest},
                        "toxicity": machine.scores(terms, owner, hi - lo),
                    }
                )
        del places
        give_back()

    return docs.select(*rest).mapInArrow(run, f"{kinds}, toxicity double")


def held_out(key, folds: int, fold: int):
    """Whether a document belongs to the rows nothing is learnt from: by its id's checksum."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % folds == fold


def labelled_rows(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Texts with a toxic label, of documents that are not held out: the ``sample`` labels of each
    kind with the smallest id hash, so few that they can be broadcast. Repeated labels count once
    and labels of unknown documents not at all, so neither takes a place. Equal rows count once."""
    known = (
        labels.select(F.col("doc_id").alias("key"), "toxic")
        .where("toxic in (0, 1) and key is not null")
        .where(~held_out(F.col("key"), 5, 0))
        .distinct()
        .join(docs.select(F.col("doc_id").alias("key")).distinct(), "key", "left_semi")
    )
    few = [
        known.where(F.col("toxic") == y).orderBy(F.xxhash64("key"), "key").limit(sample)
        for y in (0, 1)
    ]
    return (
        docs.select("doc_id", "text")
        .join(F.broadcast(few[0].union(few[1])), F.col("doc_id") == F.col("key"))
        .select("text", "toxic")
        .distinct()  # copies would make the words of one text look telling
    )


def scored_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted (score of one half or more) of each row of
    ``docs``; trained on labelled rows that are not held out. Repeated labels count once per
    row; labels of unknown documents teach nothing."""
    machine = train(store(labelled_rows(docs, labels)))
    return score(docs.select("doc_id", "text"), machine).select(
        "doc_id",
        held_out(F.col("doc_id"), 5, 0).alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.5).cast("int").alias("predicted"),
    )
