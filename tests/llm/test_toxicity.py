import random
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from heartwood.llm.toxicity import (
    Machine,
    _fit,
    _Places,
    _term_rows,
    held_out,
    labelled_rows,
    score,
    scored_documents,
    text_terms,
    train,
)


def rows(n, seed):
    """Toxic are the insults, and a mild word next to a group, never one of them alone."""
    r = random.Random(seed)
    out = []
    for i in range(n):
        words = [f"w{r.randrange(3000)}x" for _ in range(r.randrange(0, 60))]
        kind = r.randrange(5)
        if kind == 0:
            words.insert(r.randrange(len(words) + 1), r.choice(["Blorfing", "zotters"]))
        if kind in (1, 2):
            words.insert(r.randrange(len(words) + 1), "mildbad,")
        if kind in (2, 3):
            words.insert(r.randrange(len(words) + 1), "groupname")
        out.append((i, " ".join(words), int(kind in (0, 2))))
    return out


def test_learns_words_and_interactions(spark):
    data = rows(3000, 1)
    docs = spark.createDataFrame([(i, t) for i, t, _ in data], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in data], "doc_id long, toxic int")
    got = {r.doc_id: r for r in scored_documents(docs, labels).collect()}
    tested = [(got[i].predicted, y) for i, _, y in data if got[i].held_out]
    assert len(tested) > 400
    assert sum(p == y for p, y in tested) / len(tested) > 0.97
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, _, _ in data)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())


def test_scores_equal_the_formula():
    r = np.random.default_rng(1)
    m = Machine(np.arange(6), r.normal(size=6), r.normal(size=(6, 3)), 0.2)
    terms, owner = np.array([0, 2, 5, 1]), np.array([0, 0, 0, 2])
    z = 0.2 + m.weights[[0, 2, 5]].sum()
    z += sum(m.vectors[i] @ m.vectors[j] for i, j in ((0, 2), (0, 5), (2, 5)))
    got = m.scores(terms, owner, 3)
    assert np.allclose(got, 1 / (1 + np.exp(-np.array([z, 0.2, 0.2 + m.weights[1]]))))


def test_fit_without_terms():
    m = _fit(np.zeros(0, int), np.zeros(0, int), np.zeros(0, int), np.array([0.0, 1.0, 1.0]))
    assert abs(m.scores(np.zeros(0, int), np.zeros(0, int), 1)[0] - 0.5) < 0.05


def test_missing_texts_labels_and_rows(spark):
    docs = spark.createDataFrame(
        [(1, None, "t"), (1, "", "t"), (None, "zotters " * 5000, "t")],
        "doc_id long, text string, toxicity string",
    )
    none = train(docs.select("text", F.lit(None).cast("int").alias("toxic")))
    got = score(docs, none)
    assert got.columns == ["doc_id", "text", "toxicity"]
    assert max(r.toxicity for r in got.collect()) < 1e-300
    assert score(docs.where("false"), none).count() == 0
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert scored_documents(docs, labels).count() == 3
    assert docs.where(held_out(F.col("doc_id"), 1, 0)).count() == 3


def many_insults(n, seed):
    """Toxic are hundreds of insults, and a pair of words each as frequent in clean texts."""
    r = random.Random(seed)
    name = lambda i: "".join(chr(97 + (i * 7919 + 13) // 26**k % 26) for k in range(4))
    out = []
    for i in range(n):
        words = [f"{name(3000 + r.randrange(2000))}n" for _ in range(r.randrange(5, 30))]
        kind, toxic = r.randrange(4), i % 2
        if toxic and kind:
            words.append(f"{name(r.randrange(300))}zz")
        elif toxic:
            words += ["qqmild", "qqgroup"]
        elif kind < 2:
            words.append(["qqmild", "qqgroup"][kind])
        r.shuffle(words)
        out.append((i, " ".join(words), toxic, toxic and not kind))
    return out


def test_learns_hundreds_of_insults_and_a_pair_of_neutral_words(spark):
    data = many_insults(30_000, 3)
    docs = spark.createDataFrame([(i, t) for i, t, *_ in data], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y, _ in data], "doc_id long, toxic int")
    got = {r.doc_id: r for r in scored_documents(docs, labels).collect()}
    tested = [(got[i].predicted, y, pair) for i, _, y, pair in data if got[i].held_out]
    share = lambda rows: sum(p == y for p, y, _ in rows) / len(rows)
    assert share([x for x in tested if x[1] and not x[2]]) > 0.97  # insults
    assert share([x for x in tested if x[2]]) > 0.97  # the pair
    assert share([x for x in tested if not x[1]]) > 0.97


def test_places_go_to_documents(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(100)], "doc_id long, text string")
    labels = spark.createDataFrame(
        [(i, i % 2) for i in range(100)]
        + [(i, i % 2) for i in (1, 2, 3, 4, 6, 8) for _ in range(500)]  # repeated
        + [(i, i % 2) for i in range(1000, 4000)],  # unknown
        "doc_id long, toxic int",
    )
    got = [r.toxic for r in labelled_rows(docs, labels, 20).collect()]
    assert (got.count(0), got.count(1)) == (20, 20)


def test_counts_take_memory_for_the_terms_there_are():
    """Counts by label and prediction equal plain counting, and a few texts take a few MB."""
    r = random.Random(5)
    texts = [" ".join(f"w{r.randrange(200)}" for _ in range(r.randrange(0, 50))) for _ in range(400)]
    label = [r.randrange(2) for _ in texts]
    data = [np.frombuffer(t.encode(), np.uint8) for t in texts]
    terms = [text_terms(d, np.array([0, len(d)]))[0] for d in data]
    known = np.unique(np.concatenate(terms))[::40]
    m = Machine(known, np.where(np.arange(len(known)) % 2, 3.0, -3.0), np.zeros((len(known), 1)), -1.0)
    batches = [
        pa.record_batch({"text": texts[k : k + 90], "toxic": pa.array(label[k : k + 90], pa.int32())})
        for k in range(0, 400, 90)
    ]
    for machine in (None, m):
        expected = {}
        for t, y in zip(terms, label):
            at = np.flatnonzero(np.isin(known, t))
            part = 0 if machine is None else int(m.scores(at, np.zeros(len(at), int), 1)[0] >= 0.5)
            for bucket in [-1, *t.tolist()]:
                expected.setdefault((part, bucket), [0, 0])[y] += 1
        tracemalloc.start()
        rows = [x for b in _term_rows(machine)(iter(batches)) for x in b.to_pylist()]
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        got = {}
        for x in rows:
            counts = got.setdefault((x["part"], x["bucket"]), [0, 0])
            counts[0] += x["clean"]
            counts[1] += x["toxic"]
        assert {k: v for k, v in got.items() if any(v)} == expected
        assert peak < 16e6


def test_places_of_buckets():
    known = np.array([0, 7, 8, 4000, (1 << 22) - 1])
    has, at = _Places(known).find(np.array([8, 9, 0, (1 << 22) - 1, 7, 15]))
    assert has.tolist() == [True, False, True, True, True, False] and at.tolist() == [2, 0, 4, 1]
    assert not _Places(known[:0]).find(np.arange(20))[0].any()
