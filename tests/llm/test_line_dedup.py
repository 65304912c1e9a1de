import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from heartwood.llm.line_dedup import drop_common_lines, keep_bitmaps


def key(line):
    line = line.strip(" \t\n\x0b\x0c\r")
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line)


def brute(rows, min_docs, keep_first):
    held, first = defaultdict(set), {}
    for doc, text in rows:
        for i, line in enumerate((text or "").split("\n")):
            if key(line):
                held[key(line)].add(doc)
                place = (doc is not None, doc or 0, i)
                first[key(line)] = min(first.get(key(line), place), place)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        gone = [
            bool(key(x)) and len(held[key(x)]) >= min_docs
            and not (keep_first and first[key(x)] == (doc is not None, doc or 0, i))
            for i, x in enumerate(lines)
        ]
        kept = "\n".join(x for x, g in zip(lines, gone) if not g)
        out.append((doc, len(lines), sum(gone), kept))
    return out


def corpus(seed):
    r = random.Random(seed)
    common = ["Menu", " menu\t", "Étage", "ÉTAGE", "\x0b|", "", "   ", "all rights"]
    rows = [(None, "Menu\n\nx"), (None, None), (7000, ""), (7001, "\n\n"), (7002, "Menu\n" * 500)]
    for i in range(120):
        lines = [r.choice(common) if r.random() < 0.5 else f"line {r.randrange(300)}"
                 for _ in range(r.randrange(1, 12))]
        rows.append((i, "\n".join(lines) + r.choice(["", "\n", "\r\nx"])))
    return rows


@pytest.mark.parametrize("min_docs,keep_first", [(10, False), (2, True), (1, True), (3, False)])
def test_equals_brute_force(spark, min_docs, keep_first):
    rows = corpus(min_docs)
    docs = spark.createDataFrame(
        [(k, t, 1, t) for k, t in rows], "doc_id long, text string, pos int, key_a string"
    ).repartition(3)
    got = drop_common_lines(docs, min_docs, keep_first)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(
        map(str, brute(rows, min_docs, keep_first))
    )


def test_bitmaps(spark):
    rows = corpus(4)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = keep_bitmaps(docs, 3, keep_first=False).where("doc_id is not null").collect()
    texts = dict(rows)
    expected = {k: v for k, *v in brute(rows, 3, False)}
    for row in got:
        keep = np.unpackbits(np.frombuffer(zlib.decompress(row.keep), np.uint8))[: row.n_lines]
        lines = (texts[row.doc_id] or "").split("\n")
        assert "\n".join(x for x, k in zip(lines, keep) if k) == expected[row.doc_id][2]


def test_a_line_in_every_document_is_split_over_tasks(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("same\nalso").alias("text"))
    got = drop_common_lines(docs.repartition(4)).agg(
        F.sum("n_dropped"), F.max(F.length("kept"))
    ).first()
    assert tuple(got) == (8000, 0)


def test_carried_columns_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a\nb", "en")], "doc_id int, text string, lang string")
    row = drop_common_lines(docs, carry=("lang",)).first()
    assert (row.lang, row.kept) == ("en", "a\nb")
    assert drop_common_lines(docs.where("false")).count() == 0
    assert hashlib.sha256(row.kept.encode()).hexdigest()
