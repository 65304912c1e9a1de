import random
import re

import numpy as np
from pyspark.sql import functions as F

from heartwood.llm.common import text_id
from heartwood.llm.minhash_dedup import (
    BANDS,
    ROWS,
    SAMPLES,
    SKETCH_BITS,
    SLACK,
    _SIGNATURE,
    _bands_and_sketches,
    _from_signatures,
    _signatures,
    estimated_similarity,
    minhash,
    near_duplicates,
    without_near_duplicates,
)


def shingles(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both, union = len(sets[i] & sets[j]), len(sets[i] | sets[j])
            if sets[i] and sets[j] and 100 * both >= 75 * union:
                label[root(i)] = root(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), key), key)
    return [(k, len(sets[i]), least[root(i)], k == least[root(i)]) for i, (k, _) in enumerate(rows)]


def corpus(seed, groups=25):
    r = random.Random(seed)
    rows = ["", None, " \t\n", "one two", "ONE  two\n", "one two three", "\x00 a b", "été Été"]
    for _ in range(groups):
        words = [f"w{r.randrange(400)}" for _ in range(r.randrange(6, 150))]
        rows.append(" ".join(words))
        for _ in range(r.randrange(0, 6)):
            other = list(words)
            for _ in range(r.randrange(0, 5)):
                other[r.randrange(len(other))] = f"x{r.randrange(400)}"
            rows.append(r.choice([" ", "\n", "  "]).join(other).upper() if r.random() < 0.3
                        else " ".join(other))
            if r.random() < 0.3:
                words = other
    r.shuffle(rows)
    return [(i * 3 + 7, t) for i, t in enumerate(rows)]


def test_equals_brute_force(spark):
    rows = corpus(1, 40)
    docs = spark.createDataFrame(
        [(k, t, k, "x") for k, t in rows], "doc_id long, text string, node long, band string"
    ).repartition(3)
    got = sorted(tuple(r)[:4] for r in near_duplicates(docs).collect())
    assert got == sorted(brute(rows))
    assert sum(not k for *_, k in got) > 20


def test_repeated_rows_and_missing_ids(spark):
    text = "a b c d e f g"
    docs = spark.createDataFrame(
        [(4, text), (4, text), (None, text), (None, "q r s")], "doc_id long, text string"
    )
    rows = near_duplicates(docs).collect()
    assert sorted((str(r.doc_id), str(r.component_id), r.kept) for r in rows) == [
        ("4", "4", True), ("4", "4", True), ("None", "4", False), ("None", "None", True)
    ]


def test_one_row_of_each_group_stays(spark):
    text = "a b c d e f g"
    docs = spark.createDataFrame(
        [(4, text, 1), (4, text, 2), (5, text, 3), (None, "q r", 4), (None, "q r", 5), (6, "", 6),
         (7, None, 7), (8, None, 8)],
        "doc_id long, text string, _row int",
    )
    rows = without_near_duplicates(docs).collect()
    assert sorted(str(r.doc_id) for r in rows) == ["4", "6", "7", "8", "None"]
    assert rows[0].__fields__ == ["doc_id", "text", "_row"]


def test_empty_table(spark):
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_sketches_estimate_similarity(spark):
    r = np.random.default_rng(2)
    pairs = []
    for share in (0.6, 0.75, 0.9, 1.0):
        one = r.integers(0, 2**63, 2000, dtype=np.uint64)
        k = int(2000 * 2 * share / (1 + share))
        two = np.concatenate([one[:k], r.integers(0, 2**63, 2000 - k, dtype=np.uint64)])
        _, s = _bands_and_sketches(np.stack([minhash(one), minhash(two)]))
        assert s.shape == (2, SKETCH_BITS // 64)
        pairs.append((share, s[0].tolist(), s[1].tolist()))
    df = spark.createDataFrame(pairs, "share double, a array<long>, b array<long>")
    for row in df.select("share", estimated_similarity(F.col("a"), F.col("b")).alias("e")).collect():
        assert abs(row.share - row.e) < 0.15


def test_classes_that_agree_in_one_hash_stay_apart(spark):
    rows = corpus(2, 12)
    named = spark.createDataFrame(rows, "doc_id long, text string").select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"), *text_id(F.col("text"))
    )
    signed = named.mapInArrow(_signatures, _SIGNATURE).withColumn("set_a", F.lit(7).cast("long"))
    got = sorted(tuple(r)[:4] for r in _from_signatures(named, signed, 75).collect())
    assert got == sorted(brute(rows))


def test_links_lost_to_bands_and_sketches():
    """Pairs at exactly 0.75: the bands' formula, and no pair of 400,000 lost to either filter."""
    assert (1 - 0.75**ROWS) ** BANDS < 1e-6
    r = np.random.default_rng(5)
    lost = 0
    for _ in range(40):
        same = r.random((10_000, SAMPLES)) < 0.75
        one = r.integers(0, 2**32, same.shape, dtype=np.uint32)
        two = np.where(same, one, r.integers(0, 2**32, same.shape, dtype=np.uint32))
        (keys, s), (others, t) = _bands_and_sketches(one), _bands_and_sketches(two)
        ones = np.bitwise_count((s ^ t).view(np.uint64)).sum(axis=1)
        near = 1 + SKETCH_BITS / (4 * SAMPLES) * np.log(
            np.maximum(1 - 2 * ones / SKETCH_BITS, 1e-9)
        )
        lost += int((~(keys == others).any(axis=1) | (near < 0.75 - SLACK)).sum())
    assert lost == 0
