"""The pipeline, stage by stage, against plain Python on the small test tables."""

import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from heartwood.llm.queries import QUERIES
from tests.llm.test_line_dedup import brute as brute_lines
from tests.llm.test_minhash_dedup import brute as brute_near
from tests.llm.test_suffix_dedup import brute as brute_repeats

DIRECTORY = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(DIRECTORY).exists(), reason="test tables not present")


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{DIRECTORY}/documents.parquet")


def rows_of(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages(spark, documents):
    before = documents
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, DIRECTORY)
        assert after.columns == documents.columns
        old, new = rows_of(before), rows_of(after)
        if name == "toxicity":
            scored = QUERIES["op6_toxicity"](spark, DIRECTORY).collect()
            assert set(new) == {r.doc_id for r in scored if not r.predicted}
        elif name == "line dedup":
            expected = brute_lines([(k, r.text) for k, r in old.items()], 10, False)
            assert {k: r.text for k, r in new.items()} == {x[0]: x[3] for x in expected}
        elif name == "minhash near-dedup":
            expected = brute_near([(k, r.text) for k, r in old.items()])
            assert set(new) == {k for k, _, _, kept in expected if kept}
            assert all(new[k] == old[k] for k in new)
        else:
            keys = list(old)
            expected = brute_repeats([old[k].text for k in keys], 200)
            for k, (n, removed, _, kept) in zip(keys, expected):
                if len(kept.decode("utf-8", "ignore")) == len(kept.decode("utf-8", "replace")):
                    assert new[k].text == kept.decode()
                assert n - removed == len(kept) >= len(new[k].text.encode())
        assert all(r.n_chars == len(r.text) for r in new.values())
        before = spark.createDataFrame(after.collect(), documents.schema)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = Counter()
    for k, r in rows_of(before).items():
        ids = tokenizer.encode(r.text, add_special_tokens=False).ids + [1]
        for piece, at in enumerate(range(0, len(ids), 4096)):
            part = np.array(ids[at : at + 4096], "<u4")
            expected[k, piece, len(part), zlib.crc32(part.tobytes())] += 1
    whole = corpus_pipeline.run(spark, DIRECTORY).collect()
    assert Counter((r.doc_id, r.piece, r.length, r.ids_crc32) for r in whole) == expected


def test_stages_on_odd_rows(spark, documents):
    odd = spark.createDataFrame(
        [(1, None, None, None, None), (None, "", "en", "s", 0), (2, "x " * 9000, None, "s", 1),
         (2, "x " * 9000, None, "s", 1)],
        documents.schema,
    )
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd.where("false"), DIRECTORY).count() == 0
        odd = spark.createDataFrame(stage(spark, odd, DIRECTORY).collect() or [], odd.schema) \
            if stage is not corpus_pipeline.packed else stage(spark, odd, DIRECTORY)
    assert odd.where("doc_id = 2").count() >= 1
