import random

import numpy as np
import pyarrow as pa
import pytest

from heartwood.llm.common import clear_stored, components, row_blocks, store, text_buffers
from heartwood.llm.words import letter_words, spaced_words, word_hashes


@pytest.mark.parametrize("seed", range(4))
def test_components(spark, seed):
    r = random.Random(seed)
    links = [(r.randrange(80), r.randrange(80)) for _ in range(r.choice([0, 20, 50, 70]))]
    links += [(1000 + i, 1001 + i) for i in range(40)] if seed == 1 else []
    label = {}

    def root(x):
        while label.setdefault(x, x) != x:
            x = label[x]
        return x

    for a, b in links:
        p, q = sorted((root(a), root(b)))
        label[q] = p
    expected = {x: root(x) for x in list(label) if root(x) != x}
    df = spark.createDataFrame(links, "a long, b long")
    assert {r.node: r.component for r in components(df).collect()} == expected


def test_stored_tables_can_be_cleared(spark):
    kept = store(spark.range(5))
    assert kept.count() == 5
    clear_stored(spark)
    with pytest.raises(Exception):
        kept.count()


def test_text_buffers_and_blocks():
    column = pa.array(["ab", None, "", "é", "x" * 9]).slice(1)
    data, offsets = text_buffers(column)
    assert bytes(data) == "é".encode() + b"x" * 9
    assert offsets.tolist() == [0, 0, 0, 2, 11]
    assert list(row_blocks(offsets, 4)) == [(0, 3), (3, 4)]
    assert text_buffers(pa.array([], pa.string()))[1].tolist() == [0]


def test_word_hashes_name_words():
    texts = ["The the\tTHE", "", " lea\x0bve\n", "the", "été Été x\x00y"]
    data, offsets = text_buffers(pa.array(texts))
    (words, cut), owner = word_hashes(data, offsets, spaced_words(), (2,))
    assert owner.tolist() == [0, 0, 0, 2, 2, 3, 4, 4, 4]
    assert words[0] == words[1] == words[2] == words[5]
    assert len(np.unique(words)) == 6
    (short,), _ = word_hashes(*text_buffers(pa.array(["th", "x"])), spaced_words())
    assert cut[0] != short[0]  # a cut word is another term than the same short word
    (letters,), owner = word_hashes(*text_buffers(pa.array(["a-b,a 1"])), letter_words())
    assert letters[0] == letters[2] and len(letters) == 3
