import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from heartwood.llm.byte_bpe import PrefixCounter, Vocabulary
from heartwood.llm.token_counts import longest_prefix, prefix_counts, tokens_of_prefix, within_budget

PATH = public_tokenizers.path("byte_bpe_50k.json")
BITS = [
    "a", "b", "the", " ", "  ", "     ", "\n", "\t", "'re", "'s", "'", "don't", "'ll ", "1", "23",
    "...", "é", "ß", "中", "文字", "\xa0", " ", "　", "\x1c", "\x85", "<|endoftext|>",
    "<|endof", "!", "internationalization", "😀", "՘", "ൎ", "aaaa",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def counter():
    return PrefixCounter(PATH)


def by_library(library, text):
    prefixes = [text[: k + 1] for k in range(len(text))]
    return [len(e.ids) for e in library.encode_batch(prefixes, add_special_tokens=False)]


def test_every_prefix_of_mixed_texts(library, counter):
    dice = random.Random(11)
    for _ in range(1500):
        text = "".join(dice.choice(BITS) for _ in range(dice.randint(0, 14)))
        steps = np.frombuffer(counter.steps(text), np.int8)
        assert np.cumsum(steps).tolist() == by_library(library, text), repr(text)


def test_every_token_is_its_own_encoding():
    vocabulary = Vocabulary(PATH)
    assert all(vocabulary.encode_word(b) == [i] for i, b in vocabulary.bytes.items())


def test_ids_of_words_without_spaces(library):
    vocabulary, dice = Vocabulary(PATH), random.Random(12)
    for _ in range(500):
        word = "".join(dice.choice("aabcdeehilnorst") for _ in range(dice.randint(1, 60)))
        want = library.encode(word, add_special_tokens=False).ids
        assert vocabulary.encode_word(word.encode()) == want


def test_full_tables_give_the_same(library):
    small, dice = PrefixCounter(PATH), random.Random(13)
    small.entries = 50
    for _ in range(300):
        text = " ".join(dice.choice(BITS) + str(dice.randint(0, 99)) for _ in range(12))
        steps = np.frombuffer(small.steps(text), np.int8)
        assert steps.sum() == len(library.encode(text, add_special_tokens=False).ids)


def test_operator_on_odd_rows(spark, library):
    long_text = "word and another, " * 20_000 + "x" * 30_000
    texts = ["one two", None, "", "tie", "tie", "a <|endoftext|> b", long_text]
    rows = [(k % 5 if k < 6 else None, t, "kept out") for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    found = prefix_counts(docs, PATH).collect()
    want = sorted(
        (len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids))
        for t in texts
    )
    assert sorted((r.n_bytes, r.n_tokens) for r in found) == want
    assert prefix_counts(docs.limit(0), PATH).count() == 0


def test_questions_are_answered_from_what_is_stored(spark, library):
    text = "Budgets: don't cut internationalization  in half, 中文字 neither. " * 4
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    stored = prefix_counts(docs, PATH)
    counts = by_library(library, text)
    for budget in (0, 1, 7, 20, 10_000):
        row = within_budget(stored, budget).first()
        fits = [k + 1 for k, n in enumerate(counts) if n <= budget]
        assert row.fit_chars == max(fits, default=0)
        assert row.over_limit == (counts[-1] > budget)
    asked = spark.createDataFrame([(k,) for k in (0, 5, 40, 10_000, -1, None)], "k int")
    answers = asked.crossJoin(stored).select(
        "k",
        tokens_of_prefix(F.col("prefix_steps"), F.col("k")).alias("n"),
        longest_prefix(F.col("prefix_steps"), F.lit(None).cast("int")).alias("none"),
    )
    found = {r.k: (r.n, r.none) for r in answers.collect()}
    assert found == {
        0: (0, None), 5: (counts[4], None), 40: (counts[39], None),
        10_000: (counts[-1], None), -1: (None, None), None: (None, None),
    }
