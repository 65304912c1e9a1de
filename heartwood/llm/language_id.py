"""Languages of documents as a mixture, by expectation-maximisation over n-gram likelihoods.

Counts of hashed byte n-grams per language, over all labelled rows, give the likelihood of each
word under each language. A document is a mixture: each of its words comes from one of the
languages, with unknown proportions. EM finds the proportions; then languages are taken out one
by one, the least likely first, as long as the penalised likelihood (BIC) does not get worse.
What remains is the document's language set.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heartwood.llm.common import mix, row_blocks, text_buffers
from heartwood.llm.toxicity import held_out
from heartwood.llm.words import letter_words

#: hash buckets of n-grams
BUCKETS = 1 << 16
#: n-grams of bytes, with the bytes before and after a word among them
GRAMS = (2, 3, 4)
#: n-grams overlap, so a word's log-likelihood is the sum over its n-grams times this
SHARE = 1 / 3
BLOCK = 1 << 18
#: EM steps over all languages, and over each set that is tried
FIRST_STEPS, STEPS = 6, 10

_TABLE = letter_words()
_SALT = [int(x) for x in mix(np.arange(1, 9, dtype=np.uint64))]


@dataclass(frozen=True)
class Model:
    """Languages in order and the log-probability of each bucket, one table per n-gram length."""

    langs: tuple[str, ...]
    tables: np.ndarray  # (len(GRAMS), languages, BUCKETS)


def _grams(data: np.ndarray, offsets: np.ndarray) -> tuple[list, np.ndarray, np.ndarray]:
    """Hashed n-grams of each word with one space on either side.

    Returns for each length the buckets and the word of each n-gram, then each word's text and
    how many words there are of each text. All words of a block are laid out on end.
    """
    folded = _TABLE[data]
    part = folded != 0
    starts = part.copy()
    starts[1:] &= ~part[:-1]
    edge = offsets[1:-1]
    edge = edge[(edge > 0) & (edge < len(data))]
    starts[edge] = part[edge]
    first = np.flatnonzero(starts)
    owner = np.searchsorted(offsets, first, side="right") - 1
    # the words on end, one space before each and one after the last
    word = np.cumsum(starts)[part] - 1
    line = np.full(int(part.sum()) + len(first) + 1, 32, np.uint8)
    line[np.arange(len(word)) + word + 1] = folded[part]
    of = np.zeros(len(line), np.int32)
    of[np.arange(len(word)) + word + 1] = word
    space = np.flatnonzero(line == 32)
    of[space[:-1]] = np.arange(len(first))
    out = []
    wide = line.astype(np.uint32)
    for n in GRAMS:
        if len(line) < n:
            out.append((np.zeros(0, np.int64), np.zeros(0, np.int32)))
            continue
        value = np.zeros(len(line) - n + 1, np.uint32)
        gaps = np.zeros(len(value), bool)
        for j in range(n):
            value = value << np.uint32(8) | wide[j : len(value) + j]
            if 0 < j < n - 1:
                gaps |= line[j : len(value) + j] == 32
        keep = ~gaps
        bucket = value[keep] * np.uint32(_SALT[n] & 0xFFFFFFFF | 1)
        bucket ^= bucket >> np.uint32(15)
        bucket *= np.uint32(0x2C1B3C6D)
        out.append(((bucket >> np.uint32(16)).astype(np.int64), of[: len(value)][keep]))
    return out, owner, first


def _count_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """n-gram counts of the partition by language."""
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        data, offsets = text_buffers(batch.column("text"))
        names = sorted(set(langs))
        index = np.array([names.index(x) for x in langs], np.int64)
        for lo, hi in row_blocks(offsets, BLOCK):
            piece = data[offsets[lo] : offsets[hi]]
            grams, owner, _ = _grams(piece, offsets[lo : hi + 1] - offsets[lo])
            which = index[lo:hi][owner]
            for g, (bucket, word) in enumerate(grams):
                if not len(bucket):
                    continue
                both = np.bincount(which[word] * BUCKETS + bucket, minlength=len(names) * BUCKETS)
                for k, name in enumerate(names):
                    if name not in counts:
                        counts[name] = np.zeros((len(GRAMS), BUCKETS), np.int64)
                    counts[name][g] += both[k * BUCKETS : (k + 1) * BUCKETS]
    for name, table in counts.items():
        for g in range(len(GRAMS)):
            at = np.flatnonzero(table[g])
            yield pa.record_batch(
                {
                    "lang": pa.array([name] * len(at), pa.string()),
                    "gram": np.full(len(at), g, np.int32),
                    "bucket": at.astype(np.int32),
                    "n": table[g][at],
                }
            )


def train(labelled: DataFrame) -> Model:
    """A model from rows (text, lang); rows without lang or text are passed over.

    All rows are counted, summed per partition before anything is shuffled. What reaches the
    driver is at most one number per language, n-gram length and bucket.
    """
    rows = labelled.where("lang is not null and text is not null").select("text", "lang")
    counts = (
        rows.mapInArrow(_count_rows, "lang string, gram int, bucket int, n long")
        .groupBy("lang", "gram", "bucket")
        .agg(F.sum("n").alias("n"))
    ).toArrow()
    names = counts.column("lang").to_pylist()
    langs = tuple(sorted(set(names)))
    place = {x: i for i, x in enumerate(langs)}
    tables = np.full((len(GRAMS), max(len(langs), 1), BUCKETS), 0.5)
    at = np.array([place[x] for x in names], np.int64)
    tables[
        counts.column("gram").to_numpy(), at, counts.column("bucket").to_numpy()
    ] += counts.column("n").to_numpy()
    return Model(langs, np.log(tables / tables.sum(axis=2, keepdims=True)).astype(np.float32))


def _word_likelihoods(model: Model, grams, words: int) -> np.ndarray:
    """Log-likelihood of each word (column) under each language (row)."""
    out = np.zeros((len(model.langs), words), np.float32)
    for g, (bucket, word) in enumerate(grams):
        if len(bucket):
            heads = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            for k in range(len(model.langs)):
                out[k, word[heads]] += np.add.reduceat(model.tables[g, k][bucket], heads)
    out *= SHARE
    return out


def _proportions(
    words: np.ndarray, count: np.ndarray, p: np.ndarray, steps: int
) -> tuple[np.ndarray, np.ndarray]:
    """EM from proportions ``p`` (languages, texts) on, and the log-likelihood of each text.

    ``words`` has the words' likelihoods (languages, words), those of a text side by side.
    """
    first = np.cumsum(count) - count
    langs = [k for k in range(len(words)) if p[k].any()]
    p = p.copy()
    for step in range(steps + 1):
        weighted = {k: words[k] * np.repeat(p[k].astype(np.float32), count) for k in langs}
        total = np.maximum(sum(weighted.values()), np.float32(1e-30))
        if step == steps:
            return p, np.add.reduceat(np.log(total, dtype=np.float64), first)
        np.reciprocal(total, out=total)
        for k in langs:
            weighted[k] *= total
            p[k] = np.add.reduceat(weighted[k], first, dtype=np.float64) / count


def mixtures(likelihood: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Proportions of the languages in ``n`` texts and the set selected for each.

    ``likelihood`` has a column per word and a row per language, ``owner`` the text of each word
    in order. A language that explains less than one word is out at once. Texts without words
    get no language.
    """
    langs = len(likelihood)
    share, chosen = np.zeros((n, langs)), np.zeros((n, langs), bool)
    if not len(owner) or not langs:
        return share, chosen
    heads = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    texts = owner[heads]
    count = np.diff(np.append(heads, len(owner)))
    top = likelihood.max(axis=0)
    scaled = np.exp(np.maximum(likelihood - top, -60.0), dtype=np.float32)

    p, _ = _proportions(scaled, count, np.full((langs, len(texts)), 1 / langs), FIRST_STEPS)
    best = p.argmax(axis=0)
    active = p * count >= 1
    active[best, np.arange(len(texts))] = True

    # texts with several languages left: take out the weakest while the penalty pays for it
    todo = np.flatnonzero(active.sum(axis=0) > 1)
    fitness = np.full(len(texts), -np.inf)
    while len(todo):
        which = np.zeros(len(texts), bool)
        which[todo] = True
        words, size = scaled[:, np.repeat(which, count)], count[todo]
        several = np.isneginf(fitness[todo])
        trial = active[:, todo].copy()
        weakest = np.where(trial, p[:, todo], np.inf).argmin(axis=0)
        trial[weakest, np.arange(len(todo))] &= several  # the first visit measures the full set
        start = np.where(trial, np.maximum(p[:, todo], 0.01), 0.0)
        q, other = _proportions(words, size, start / start.sum(axis=0), STEPS)
        better = several | (other + 0.5 * np.log(size + 1.0) >= fitness[todo])
        at = todo[better]
        active[:, at], p[:, at], fitness[at] = trial[:, better], q[:, better], other[better]
        todo = at[active[:, at].sum(axis=0) > 1]
    p = np.where(active, p, 0.0)
    share[texts], chosen[texts] = (p / p.sum(axis=0)).T, active.T
    return share, chosen


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with lang_pred (the largest proportion), score (that proportion) and languages
    (an array of the selected set, largest proportion first).

    A text that is missing or has no letter gets ``und``, score 0 and an empty set; so does
    every text if the model knows no language. Letters are those of Unicode. A text whose
    letters are all outside the model's n-grams gets a language by its smoothing, ties go to the
    first in order. All columns stay; those of the three new names are replaced.
    """
    new = ("lang_pred", "score", "languages")
    rest = [c for c in docs.columns if c not in new]
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in rest)
    names = np.array([*model.langs, "und"], object)
    flag = "has_letter"
    while flag in docs.columns:
        flag += "_"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            letters = batch.column(flag).to_numpy(zero_copy_only=False)
            data, offsets = text_buffers(batch.column("text"))
            for lo, hi in row_blocks(offsets, BLOCK):
                piece = data[offsets[lo] : offsets[hi]]
                grams, owner, first = _grams(piece, offsets[lo : hi + 1] - offsets[lo])
                share, chosen = mixtures(
                    _word_likelihoods(model, grams, len(first)), owner, hi - lo
                )
                known = letters[lo:hi] & chosen.any(axis=1)
                best = np.where(known, share.argmax(axis=1) if model.langs else 0, -1)
                order = np.argsort(-share, axis=1, kind="stable")
                sets = [
                    [names[k] for k in order[i] if chosen[i, k]] if known[i] else []
                    for i in range(hi - lo)
                ]
                rows = batch.slice(lo, hi - lo)
                yield pa.record_batch(
                    {
                        **{c: rows.column(c) for c in rest},
                        "lang_pred": pa.array(names[best].tolist(), pa.string()),
                        "score": np.where(known, np.clip(share.max(axis=1, initial=0), 0, 1), 0.0),
                        "languages": pa.array(sets, pa.list_(pa.string())),
                    }
                )

    has_letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    return docs.select(*rest, has_letter.alias(flag)).mapInArrow(
        run, f"{kinds}, lang_pred string, score double, languages array<string>"
    )


def identified_documents(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score and languages of each row of ``docs``; learnt from
    text and lang of the rows that are not held out."""
    out = held_out(F.col("doc_id"), 4, 2)
    model = train(docs.where(~out).select("text", "lang"))
    return identify(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "lang_pred", "score", "languages"
    )
