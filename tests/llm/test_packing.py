import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from heartwood.llm.packing import pack, packing_plan

PATH = public_tokenizers.path("word_bpe_49k.json")


def check_places(rows, capacity):
    """rows: (sequence, offset, length); gapless from 0, within capacity."""
    held = defaultdict(list)
    for sequence, offset, length in rows:
        held[sequence].append((offset, length))
    for places in held.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(held)


def expand(plan):
    return [
        (length, rank, first + (rank - lo) // each, offset + (rank - lo) % each * length)
        for length, lo, hi, first, each, offset in plan
        for rank in range(lo, hi)
    ]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 60), max_size=200))
def test_plan_places_each_piece_once(lengths):
    counts = Counter(lengths)
    rows = expand(packing_plan(counts, 60))
    assert sorted((x, r) for x, r, *_ in rows) == sorted(
        (x, r) for x, n in counts.items() for r in range(n)
    )
    n = check_places([(s, o, x) for x, _, s, o in rows], 60)
    assert n >= -(-sum(lengths) // 60)


def best_fit_decreasing(lengths, capacity):
    bins = []
    for x in sorted(lengths, reverse=True):
        fits = [i for i, room in enumerate(bins) if room >= x]
        if fits:
            bins[min(fits, key=lambda i: bins[i])] -= x
        else:
            bins.append(capacity - x)
    return len(bins)


@pytest.mark.parametrize("seed", range(8))
def test_plan_is_as_good_as_best_fit_decreasing(seed):
    r = random.Random(seed)
    lengths = [min(400, int(r.lognormvariate(4, 1)) + 1) for _ in range(800)]
    rows = expand(packing_plan(Counter(lengths), 400))
    n = len({s for _, _, s, _ in rows})
    assert n <= best_fit_decreasing(lengths, 400) * 1.01 + 1


def test_large_items_are_matched():
    counts = {100: 3, 67: 2, 60: 1, 40: 2, 34: 3}
    rows = expand(packing_plan(counts, 100))
    n = check_places([(s, o, x) for x, _, s, o in rows], 100)
    assert n == 3 + 1 + 1 + 1 + 2  # alone; 60+40; 40+34; 34+34; 67 twice


def test_pack_equals_plain_encoding(spark):
    r = random.Random(1)
    t = Tokenizer.from_file(PATH)
    odd = [
        None, "", " ", "\n\t\r\x0b\x0c\x1c\x85 x", "It's <|endoftext|> a'lĺ b", "ÀÉ ﬁ 漢字 1234",
        "á ́b", "x" * 3000, "<|startoftext|>y <|endoftext|>",
    ]
    words = ["Tion", "the", "über", "ñandú's", "42", "\n", "--", "a|b"]
    odd += [" ".join(r.choices(words, k=r.randrange(1, 300))) for _ in range(30)]
    rows = [(i if i % 7 else None, text, i, "s") for i, text in enumerate(odd)] + [(1, "a b", 0, "")] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, length int, salt string")
    capacity = 64
    got = pack(docs.repartition(3), PATH, capacity=capacity).collect()
    check_places([(x.sequence_id, x.offset, x.length) for x in got], capacity)
    expected = Counter()
    for key, text, *_ in rows:
        ids = t.encode(text or "", add_special_tokens=False).ids + [1]
        for k, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at : at + capacity]
            expected[key, k, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    assert Counter((x.doc_id, x.piece, x.start, x.length, x.ids_crc32) for x in got) == expected


def test_empty_table(spark):
    assert pack(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0


def test_special_tokens_in_other_case():
    from heartwood.llm.packing import WordTokens

    plain, words = Tokenizer.from_file(PATH), WordTokens(PATH)
    texts = [
        "a <|ENDOFTEXT|> b", "A <|endoftext|> B.", "x<|EndOfText|>Y, z", "<|START of|> <|",
        "a <|<|endoftext|> <|ENDOF\nTEXT|> Q", "|> <|STARTOFTEXT|><|startoftext|>",
    ]
    for text, ids in zip(texts, words.ids(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids
