import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from heartwood.llm import suffix_dedup
from heartwood.llm.suffix_dedup import merged_intervals, remove_repeats, shard_order


def brute(texts, window):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + window] for d in data for i in range(len(d) - window + 1))
    out = []
    for d in data:
        cover = bytearray(len(d))
        for i in range(len(d) - window + 1):
            if seen[d[i : i + window]] > 1:
                cover[i : i + window] = b"\1" * window
        spans = sum(1 for i, c in enumerate(cover) if c and (i == 0 or not cover[i - 1]))
        out.append((len(d), sum(cover), spans, bytes(b for b, c in zip(d, cover) if not c)))
    return out


def corpus(seed, n=60):
    r = random.Random(seed)
    words = ["wort", "été", "of", "the", "漢字", "a", "sand", "\n", "loop "]
    prose = lambda k: " ".join(r.choice(words) + str(r.randrange(50)) for _ in range(k))
    passages = [prose(r.randrange(20, 80)) for _ in range(5)]
    texts = [None, "", "short", "ab" * 400, "ab" * 300, "x" * 199, "y" * 200, "y" * 200]
    for _ in range(n):
        t = prose(r.randrange(1, 120))
        if r.random() < 0.5:
            t += r.choice(passages) + prose(r.randrange(0, 30))
        texts.append(t)
        if r.random() < 0.2:
            texts.append(t)
        if r.random() < 0.2:
            texts.append(t[:150] + "#" + t[151:])
    r.shuffle(texts)
    return texts


@pytest.mark.parametrize("window", [32, 96, 200])
def test_equals_brute_force(spark, window):
    texts = corpus(window)
    docs = spark.createDataFrame(
        [(i, t, "n", 1) for i, t in enumerate(texts)],
        "doc_id long, text string, name string, text_a int",
    ).repartition(3)
    got = {r.doc_id: tuple(r)[1:] for r in remove_repeats(docs, window).collect()}
    expected = brute(texts, window)
    assert {i: (*v[:3], bytes(v[3])) for i, v in got.items()} == dict(enumerate(expected))
    assert any(v[1] for v in expected)


def test_rows_are_documents_and_ids_may_be_missing(spark):
    long = "".join(chr(97 + i * i % 26) for i in range(300))
    docs = spark.createDataFrame(
        [(1, long), (1, long), (None, "unique"), (None, None)], "doc_id long, text string"
    )
    rows = remove_repeats(docs).collect()
    assert sorted((r.n_bytes, r.n_removed) for r in rows) == [(0, 0), (6, 0), (300, 300), (300, 300)]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert remove_repeats(docs).collect() == []


def test_merged_intervals_and_common_prefixes():
    r = random.Random(3)
    spans = [bytes(r.choices(b"ab", k=r.randrange(40, 90))) for _ in range(30)]
    window = 8
    marks, common = merged_intervals(spans, np.ones(30, int), np.arange(30) % 4, window)
    seen = Counter(s[i : i + window] for s in spans for i in range(len(s) - window + 1))
    at = 0
    for s in spans:
        for i in range(len(s) - window + 1):
            assert marks[at + i] == (seen[s[i : i + window]] > 1)
            assert common[at + i] == window * (seen[s[i : i + window]] > 1)
        at += len(s) + 1


def test_shard_order_sorts_suffixes():
    r = random.Random(5)
    text = bytes(r.choices(b"abc", k=500)) + b"abcabcab" * 30 + b"\0" * 300
    order = shard_order(np.frombuffer(text, np.uint8), np.zeros(len(text), np.int32), 200)
    keys = [text[i : i + 200] for i in order.tolist()]
    assert sorted(order.tolist()) == list(range(len(text)))
    assert all(a.ljust(200, b"\0") <= b.ljust(200, b"\0") for a, b in zip(keys, keys[1:]))


def test_kept_bytes_hash(spark):
    docs = spark.createDataFrame([(1, "é" * 150), (2, "é" * 150)], "doc_id long, text string")
    for row in remove_repeats(docs).collect():
        assert hashlib.sha256(row.kept).hexdigest() == hashlib.sha256(b"").hexdigest()


def test_spans_of_copies_are_merged_only_with_others_of_their_name(monkeypatch):
    """A name with one span that stands for copies needs no merge; every other name does."""
    r = random.Random(9)
    window = 32
    span = lambda n: bytes(r.choices(b"abcdef", k=n))
    one, two, own = span(60), span(50), span(20) * 5
    rows = [  # name, span, text_a, text_b, start, copies
        (1, one, 10, 0, 5, 1), (1, one, 11, 0, 7, 1),  # copies only
        (2, one[:40], 12, 0, 0, 1), (2, one, 13, 0, 3, 2),  # copies and a part of them
        (3, own, 14, 0, 2, 1),  # repeats itself
        (4, two, 15, 0, 9, 4),  # copies only
        (5, span(45), 16, 0, 0, 1),  # nothing
    ]
    rows.sort(key=lambda x: x[:2])
    merged = []
    plain = suffix_dedup.merged_intervals

    def seen(spans, *rest):
        merged.extend(spans)
        return plain(spans, *rest)

    monkeypatch.setattr(suffix_dedup, "merged_intervals", seen)
    for size in (1, 3, 100):
        merged.clear()
        names = ("name", "span", "text_a", "text_b", "start", "copies")
        batches = [
            pa.record_batch(dict(zip(names, map(list, zip(*rows[k : k + size])))))
            for k in range(0, len(rows), size)
        ]
        got = {
            (x["text_a"], x["lo"], x["hi"])
            for b in suffix_dedup._merge(window)(iter(batches))
            for x in b.to_pylist()
        }
        assert got == {
            (10, 5, 65), (11, 7, 67), (12, 0, 40), (13, 3, 63), (14, 2, 102), (15, 9, 59)
        }
        assert sorted(merged) == sorted(x[1] for x in rows if x[0] in (2, 3, 5))
