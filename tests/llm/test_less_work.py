"""Stages of the pipeline leave out work that decides nothing, and decide as before."""

import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from heartwood.llm import common, line_dedup, minhash_dedup, packing, suffix_dedup, toxicity

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_only_windows_met_twice_are_merged(monkeypatch):
    """Spans that share a name but no window are not merged, and copies need no merge either."""
    merged = []
    plain = suffix_dedup._interleaved

    def seen(spans, *rest):
        merged.extend(spans)
        return plain(spans, *rest)

    monkeypatch.setattr(suffix_dedup, "_interleaved", seen)
    r = random.Random(3)
    text = lambda n: bytes(r.choices(b"abcdef", k=n))
    same = text(300)
    spans = [text(400) + same + text(50), text(80) + same, *[text(500) for _ in range(20)]]
    marks, common = suffix_dedup.merged_intervals(
        spans, np.ones(22, int), np.arange(22, dtype=np.int32) % 8, 100, False
    )
    assert common is None and not merged
    assert np.flatnonzero(marks).tolist() == [*range(400, 601), *range(751 + 80, 751 + 281)]


def test_repeated_windows_equal_brute_force():
    r = random.Random(1)
    for _ in range(300):
        window, letters = r.choice([5, 8, 32, 40]), r.choice([b"ab", b"abcdef", b"a"])
        base = [bytes(r.choices(letters, k=r.randrange(1, 200))) for _ in range(r.randrange(1, 6))]
        spans = []
        for _ in range(r.randrange(1, 25)):
            x = r.choice(base)
            i = r.randrange(len(x))
            spans.append(x[i : r.randrange(i, len(x) + 1)] + bytes(r.choices(letters, k=5)))
        spans = list(dict.fromkeys(spans))
        weights = np.array([r.choice([1, 1, 1, 2, 3]) for _ in spans])
        shard = np.arange(len(spans), dtype=np.int32) % 4
        marks, _ = suffix_dedup.merged_intervals(spans, weights, shard, window, False)
        seen = Counter()
        for s, n in zip(spans, weights.tolist()):
            for i in range(len(s) - window + 1):
                seen[s[i : i + window]] += n
        want = [
            i + window <= len(s) and seen[s[i : i + window]] > 1
            for s in spans
            for i in range(len(s) + 1)
        ]
        assert marks.tolist() == want


def test_lines_are_hashed_without_a_plan_of_characters(spark, monkeypatch):
    """Keys: white space at the ends is gone, A-Z lower-cased and nothing else."""
    monkeypatch.setattr(line_dedup, "LINES", 2)
    texts = ["Éa\n éa\t\n\nÉA ", "\x0bABC\r\nabc\n\x85abc", "", "ßß\nß"]
    docs = spark.createDataFrame(
        [(k or None, k, k, t) for k, t in enumerate(texts)],
        "doc_id long, text_a long, text_b long, text string",
    ).coalesce(1)
    hashed = line_dedup._line_hashes(docs, 2)
    plan = hashed._jdf.queryExecution().executedPlan().toString()
    assert "translate" not in plan and "posexplode" not in plan
    rows = sorted((r.text_a, r.pos, r.key_a, r.key_b, r.doc_id) for r in hashed.collect())
    assert [r[:2] for r in rows] == [(0, 0), (0, 1), (0, 3), (1, 0), (1, 1), (1, 2), (3, 0)]
    assert [r[4] for r in rows] == [None, None, None, 1, 1, 1, 3]
    keys = [r[2:4] for r in rows]
    assert keys[0] == keys[2] and keys[0] != keys[1] and keys[3] == keys[4] != keys[5]
    assert line_dedup._line_hashes(docs, 0).count() == 10


def test_rows_without_a_candidate_get_no_sets(monkeypatch):
    """Of a bucket's members only those go on that have a pair: near by sketch, in another
    component, with no earlier band in common."""
    r = np.random.default_rng(7)
    samples = r.integers(0, 2**32, (60, minhash_dedup.SAMPLES), dtype=np.uint32)
    for i in range(1, 60):
        same = r.random(minhash_dedup.SAMPLES) < r.choice([0.2, 0.6, 0.9])
        samples[i, same] = samples[r.integers(0, i), same]
    keys, sketches = minhash_dedup._bands_and_sketches(samples)
    inside = r.integers(0, 25, 60)
    rows = []
    for j in range(minhash_dedup.BANDS):
        for band in np.unique(keys[:, j]):
            at = np.flatnonzero(keys[:, j] == band)
            for block in range(2):
                for own in (True, False):
                    mine = at if own else at[at % 2 == block]
                    rows += [(int(band), block, 0, own, int(i), int(inside[i])) for i in mine]
    rows.sort(key=lambda x: (*x[:3], not x[3]))
    least = 0.5
    near = [minhash_dedup._near(sketches, sketches[i]) >= least for i in range(60)]
    want = set()
    for band, block, own_block, own, i, c in rows:
        for other in rows:
            if other[:3] != (band, block, own_block) or other[3] == own:
                continue
            k = other[4]
            first = (keys[i] == keys[k]).argmax()
            if inside[k] != c and near[i][k] and keys[i][first] == band:
                want.add((band, block, own_block, own, i, c))
    assert 0 < len(want) < len(rows) / 2
    names = ("band", "block", "own_block", "own", "node", "inside")
    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.int64(), pa.int64())
    for size, pairs in ((1, 1), (7, 3), (10_000, 50_000)):
        monkeypatch.setattr(minhash_dedup, "PAIRS", pairs)
        batches = []
        for k in range(0, len(rows), size):
            some = rows[k : k + size]
            columns = dict(zip(names, map(pa.array, zip(*some), kinds)))
            at = [x[4] for x in some]
            columns["sketch"] = pa.array(sketches[at].tolist(), pa.list_(pa.int64()))
            columns["bands"] = pa.array(keys[at].tolist(), pa.list_(pa.int64()))
            batches.append(pa.record_batch(columns))
        got = [
            tuple(x[c] for c in names)
            for b in minhash_dedup._with_partner(least)(iter(batches))
            for x in b.to_pylist()
        ]
        assert len(got) == len(set(got)) and set(got) == want


@pytest.mark.parametrize("few", [-1, 1 << 20])
def test_few_links_need_no_rounds(spark, monkeypatch, few):
    """The driver finds the same components as rounds do, which it then leaves out."""
    rounds = []
    settled = common._is_settled
    monkeypatch.setattr(common, "_is_settled", lambda e: rounds.append(1) or settled(e))
    monkeypatch.setattr(common, "FEW_LINKS", few)
    links = [(i, i + 1) for i in range(30)] + [(99, 40), (50, 99), (7, 7), (None, 3), (-5, 60)]
    links += [(61, 60), (99, 40)]
    df = spark.createDataFrame(links, "a long, b long")
    found = common.components(df)
    assert found.dtypes == [("node", "bigint"), ("component", "bigint")]
    want = {i: 0 for i in range(1, 31)} | {99: 40, 50: 40, 60: -5, 61: -5}
    assert {r.node: r.component for r in found.collect()} == want and found.count() == len(want)
    assert common.components(df.where("a = b")).count() == 0
    assert bool(rounds) == (few < 0)


def test_kept_rows_are_shuffled_once(spark):
    """The join with the kept ids and the grouping of repeated rows share one exchange."""
    docs = spark.createDataFrame([(4, "a b"), (4, "a b"), (None, "c")], "doc_id long, text string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = minhash_dedup.without_near_duplicates(docs)
        plan = kept._jdf.queryExecution().sparkPlan().toString()
        prepared = kept._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "LeftSemi" in plan
    above = prepared[: prepared.index("LeftSemi")]
    assert "Exchange" not in above
    assert sorted((str(r.doc_id), r.text) for r in kept.collect()) == [("4", "a b"), ("None", "c")]


def test_fit_equals_plain_sums():
    """Weights of the fit by columns against sums over a dense matrix."""
    r = np.random.default_rng(3)
    n, m = 40, 12
    there = r.random((n, m)) < 0.3
    there[5] = False
    owner, terms = np.nonzero(there)
    label = (there[:, 0] | (there[:, 1] & there[:, 2])).astype(float)
    got = toxicity._fit(np.arange(m), terms.astype(np.int32), owner, label, rounds=6)
    x = there.astype(float)
    w, v, c = np.zeros(m), np.random.default_rng(7).normal(0, 0.01, (m, 4)), 0.0
    gw, gv, gc = np.full(m, 1e-8), np.full((m, 4), 1e-8), 1e-8
    weight = np.where(label == 1, 0.5 / label.sum(), 0.5 / (1 - label).sum())
    for _ in range(6):
        total = x @ v
        z = c + x @ w + 0.5 * ((total**2).sum(axis=1) - x @ (v**2).sum(axis=1))
        error = (1 / (1 + np.exp(-z)) - label) * weight
        dc, dw = error.sum(), x.T @ error
        dv = x.T @ (error[:, None] * total) - v * dw[:, None] + 1e-6 * v
        dw = dw + 1e-6 * w
        gc, gw, gv = gc + dc**2, gw + dw**2, gv + dv**2
        c, w, v = c - 0.3 * dc / gc**0.5, w - 0.3 * dw / gw**0.5, v - 0.3 * dv / gv**0.5
    assert np.allclose(got.weights, w) and np.allclose(got.vectors, v)


def test_plain_words_need_no_tokenizer(monkeypatch):
    """Ids equal the tokenizer's; it is asked only for words that are not letters and signs."""
    tokens = packing.WordTokens(PATH)
    asked = []
    real = tokens.tokenizer

    class Watched:
        def encode(self, text, **options):
            asked.append(text)
            return real.encode(text, **options)

    monkeypatch.setattr(tokens, "tokenizer", Watched())
    r = random.Random(4)
    letters = "abcdefghijklmnopqrstuvwxyz" * 3 + "ABXYZßàáéîöøúÿÀÖØÞñç"
    signs, others = "!\"#$%&()*+,-./:;=?@[\\]^_`{}~", "'0123 <|>́ŉµªœ"
    texts = []
    for _ in range(400):
        words = []
        for _ in range(r.randrange(0, 40)):
            word = "".join(r.choices(letters, k=r.randrange(0, 14)))
            word += "".join(r.choices(signs, k=r.choice([0, 0, 0, 1, 2, 4])))
            if r.random() < 0.1:
                word += "".join(r.choices(others + letters, k=r.randrange(1, 6)))
            if r.random() < 0.02:
                word = "the" * r.randrange(1, 90)
            words.append(word)
        texts.append(" ".join(words))
    for k in range(0, 400, 50):
        for text, ids in zip(texts[k : k + 50], tokens.ids(texts[k : k + 50])):
            want = real.encode(text, add_special_tokens=False).ids
            assert ids == np.array(want, "<u4").tobytes()
    asked.clear()
    tokens.ids(["Neuwörter stehen: (hier) xyzzyq%%%"])
    assert asked == ["(hier)"]
    assert packing._Merges.of(PATH) is not None
    assert packing._holes([None, 1, None, None]) == [0, 2, 3] and packing._holes([]) == []
