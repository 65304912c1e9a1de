import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from heartwood.llm.alignment import Encoders, PerfectHash, align, pair_key
from heartwood.llm.byte_bpe import byte_letters

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
BITS = [
    "the", " ", " ", " ", "  ", "   ", "\n", "\n\n", "\n ", " \n", "\t", "'re", "don't", "12", "...", "é", "中文字",
    "internationalization", "😀", "▁", "<|endoftext|>", "<s>", "<0x41>", "cats,", "\xa0", "\x85",
]


def by_the_book(rows):
    """The contract, text by text, with both libraries and plain loops."""
    first = Tokenizer.from_file(A)
    first.encode_special_tokens = True
    second = SentencePieceProcessor(model_file=B)
    letters = byte_letters()
    aligned = []
    for key, text in rows:
        a = first.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        b = second.encode(text) if text else []
        bytes_a = [bytes(letters[c] for c in first.id_to_token(i)) for i in a]
        bytes_b = []
        for i in b:
            piece = second.id_to_piece(i)
            byte = second.is_byte(i)
            bytes_b.append(bytes([int(piece[3:5], 16)]) if byte else piece.replace("▁", " ").encode())
        whole = b" " + (text or "").encode()
        if not text or b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
            aligned.append((key, [], [], [], ""))
            continue
        ends_b, at = {}, 0
        for j, x in enumerate(bytes_b):
            at += len(x)
            ends_b[at] = j
        links, groups, at, i0, j0 = [], [], 0, 0, 0
        for i, x in enumerate(bytes_a):
            at += len(x)
            if at in ends_b:
                j = ends_b[at]
                links.append((a[i], b[j]))
                groups.append(
                    ",".join(map(str, a[i0 : i + 1])) + "|" + ",".join(map(str, b[j0 : j + 1]))
                )
                i0, j0 = i + 1, j + 1
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
        aligned.append((key, a, b, links, digest))
    counts = Counter(link for row in aligned for link in row[3])
    highest = defaultdict(int)
    for (_, y), n in counts.items():
        highest[y] = max(highest[y], n)
    return [
        (
            key, len(a), len(b), len(links), len(links),
            sum(counts[x] == highest[x[1]] for x in links), sum(counts[x] for x in links), digest,
        )
        for key, a, b, links, digest in aligned
    ]


def mixed_rows(n, seed):
    dice = random.Random(seed)
    words = ["alpha", "beta", "gamma's", "delta.", "x", "unbelievable", "Straße", "2024,"]
    rows = []
    for key in range(n):
        bits = BITS if key % 2 else [w + " " for w in words]
        rows.append((key, "".join(dice.choice(bits) for _ in range(dice.randint(0, 20))).rstrip(" " * (key % 3))))
    return rows


def test_equals_the_contract_by_plain_loops(spark):
    rows = mixed_rows(400, 3)
    rows += [(1000, None), (1001, ""), (1002, " "), (1003, "  "), (None, rows[0][1]), (5, rows[5][1])]
    rows.append((1004, "long text " * 30_000))
    data = [(k, t, "clash") for k, t in rows]
    docs = spark.createDataFrame(data, "doc_id long, text string, n_a string").repartition(5)
    order = lambda r: (r[0] is None, r[0] or 0, r)
    found = sorted((tuple(r) for r in align(docs, A, B).collect()), key=order)
    assert found == sorted(by_the_book(rows), key=order)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert align(docs, A, B).count() == 0
    nothing = spark.createDataFrame([(1, None)], "doc_id long, text string")
    assert [tuple(r) for r in align(nothing, A, B).collect()] == [(1, 0, 0, 0, 0, 0, 0, "")]


@pytest.mark.parametrize("n", [0, 1, 2, 17, 50_000])
def test_perfect_hash_numbers_each_key_once(n):
    dice = np.random.default_rng(n)
    keys = np.unique(pair_key(dice.integers(0, 50_000, n), dice.integers(0, 32_000, n)))
    table = PerfectHash.of(np.concatenate([keys, keys[:5]]))
    assert sorted(table.number(keys).tolist()) == list(range(len(keys)))
    others = np.setdiff1d(keys + np.uint64(1), keys)
    assert (table.number(others) == -1).all()


def test_words_give_the_ids_of_whole_texts():
    both = Encoders(A, B)
    first = Tokenizer.from_file(A)
    first.encode_special_tokens = True
    second = SentencePieceProcessor(model_file=B)
    texts = [t for _, t in mixed_rows(3000, 4) if t]
    for text, (a, b, _) in zip(texts, both.encode(texts)):
        if a:
            assert np.frombuffer(a, both.kind).tolist() == first.encode(" " + text, add_special_tokens=False).ids
            assert np.frombuffer(b, both.kind).tolist() == second.encode(text)


def test_pairs_are_bounded_by_the_vocabularies():
    both = Encoders(A, B)
    assert both.lengths_a.sum() + both.lengths_b.sum() < 1_000_000
