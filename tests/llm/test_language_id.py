import random
import zlib

import numpy as np
import pytest

from heartwood.llm.language_id import identified_documents, identify, mixtures, train

STEMS = {
    "aa": ["kora", "mila", "tuna", "rasol", "péna"],
    "bb": ["schtrug", "vlonk", "grumpf", "ächz", "dronk"],
    "cc": ["xiyo", "quezu", "yixo", "zuqui", "oxyi"],
}


def prose(r, lang, n):
    return " ".join("".join(r.choices(STEMS[lang], k=r.randrange(1, 3))) for _ in range(n))


def corpus(n, seed):
    r = random.Random(seed)
    return [(i, prose(r, lang := r.choice(list(STEMS)), r.randrange(3, 80)), lang) for i in range(n)]


def test_held_out_accuracy(spark):
    data = corpus(600, 1)
    docs = spark.createDataFrame(
        [(*x, "q", 1.0) for x in data], "doc_id long, text string, lang string, lang_pred string, score double"
    )
    got = identified_documents(docs).collect()
    lang = {i: x for i, _, x in data}
    tested = [r for r in got if r.held_out]
    assert len(tested) > 100
    assert sum(r.lang_pred == lang[r.doc_id] for r in tested) / len(tested) > 0.98
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)


def test_mixtures_are_found(spark):
    r = random.Random(3)
    model = train(spark.createDataFrame(corpus(400, 2), "doc_id long, text string, lang string"))
    mixed = [(i, prose(r, "aa", 60) + "\n" + prose(r, "cc", 30)) for i in range(20)]
    rows = identify(spark.createDataFrame(mixed, "doc_id long, text string"), model).collect()
    assert all(row.lang_pred == "aa" and row.languages == ["aa", "cc"] for row in rows)
    assert all(abs(row.score - 2 / 3) < 0.12 for row in rows)


@pytest.mark.parametrize("text", [None, "", "12 34!", "\n\t", "😀 ½"])
def test_no_letter(spark, text):
    docs = spark.createDataFrame([(1, text), (None, "kora mila")], "doc_id long, text string")
    model = train(spark.createDataFrame(corpus(50, 2), "doc_id long, text string, lang string"))
    got = {r.doc_id: r for r in identify(docs, model).collect()}
    assert (got[1].lang_pred, got[1].score, got[1].languages) == ("und", 0.0, [])
    assert got[None].lang_pred == "aa"


def test_nothing_learnt_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "kora", None)], "doc_id long, text string, lang string")
    model = train(docs)
    assert identify(docs, model).first().lang_pred == "und"
    assert identify(docs.where("false"), model).count() == 0


def test_em_equals_a_plain_loop():
    r = np.random.default_rng(4)
    likelihood = np.log(r.random((2, 30)))
    share, chosen = mixtures(likelihood, np.zeros(30, int), 1)
    p = np.array([0.5, 0.5])
    for _ in range(200):
        w = np.exp(likelihood.T) * p
        p = (w / w.sum(axis=1, keepdims=True)).mean(axis=0)
    if chosen[0].all():
        assert np.allclose(share[0], p, atol=0.05)
    assert np.isclose(share[0].sum(), 1)


def test_clashing_columns_stay(spark):
    model = train(spark.createDataFrame(corpus(50, 2), "doc_id long, text string, lang string"))
    docs = spark.createDataFrame(
        [(1, "kora mila", "mine", 7, 0.5)],
        "doc_id long, text string, has_letter string, has_letter_ int, score double",
    )
    row = identify(docs, model).first()
    assert (row.has_letter, row.has_letter_, row.lang_pred) == ("mine", 7, "aa")
