"""Token counts of every prefix of every text, stored once and asked often.

Texts are encoded by byte-level BPE as prefix dynamic programming (``byte_bpe``), which gives the
exact number of tokens of each prefix on the way. The counts are kept as differences from one code
point to the next, a byte each and deflated. How many tokens the first characters of a text have,
where to cut it for a budget and whether it fits are then read off, without encoding anything.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from heartwood.llm.byte_bpe import PrefixCounter

@cache
def _counter(path: str) -> PrefixCounter:
    """A Python worker keeps its tables from task to task."""
    return PrefixCounter(path)


def _count(path: str):
    """Arrow function: size, number of tokens and stored prefix counts of each text."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(path)
        for batch in batches:
            totals, stored = [], []
            for text in batch.column("text"):
                steps = counter.steps(text.as_py() or "")
                totals.append(int(np.frombuffer(steps, np.int8).sum(dtype=np.int64)))
                stored.append(zlib.compress(steps, 1))
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id"),
                    "n_bytes": pc.fill_null(
                        pc.binary_length(batch.column("text")).cast(pa.int64()), 0
                    ),
                    "n_tokens": pa.array(totals, pa.int64()),
                    "prefix_steps": pa.array(stored, pa.binary()),
                }
            )

    return count


def prefix_counts(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Rows (doc_id, n_bytes, n_tokens, prefix_steps): the counts of each text's prefixes.

    ``tokenizer`` is a byte-level BPE file of the tokenizers library; counts are those of the
    library without added special tokens, while special tokens in a text count as one. The
    number of tokens of a text's first k characters (code points) is the sum of the first k
    of the signed bytes in ``prefix_steps``; use :func:`tokens_of_prefix` and
    :func:`longest_prefix`.

    Every row is counted by itself, also with a repeated or missing doc_id. A missing or empty
    text has 0 tokens. Long texts are read whole; memory grows with the longest text of a batch.
    An empty table gives an empty result; other columns of ``docs``, whatever their names, play
    no role.
    """
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _count(tokenizer),
        "doc_id long, n_bytes long, n_tokens long, prefix_steps binary",
    )


def _counts(steps: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(zlib.decompress(steps), np.int8), dtype=np.int64)


@F.udf(LongType(), useArrow=True)
def _tokens_at(steps: bytes | None, characters: int | None) -> int | None:
    if steps is None or characters is None or characters < 0:
        return None
    counts = _counts(steps)[:characters]
    return int(counts[-1]) if len(counts) else 0


@F.udf(LongType(), useArrow=True)
def _cut_at(steps: bytes | None, budget: int | None) -> int | None:
    if steps is None or budget is None or budget < 0:
        return None
    fits = np.flatnonzero(_counts(steps) <= budget)
    return int(fits[-1]) + 1 if len(fits) else 0


def tokens_of_prefix(steps: Column, characters: Column) -> Column:
    """Number of tokens of a text's first characters; of the whole text, if it has fewer.

    NULL where an argument is NULL or the number of characters is negative.
    """
    return _tokens_at(steps, characters)


def longest_prefix(steps: Column, budget: Column) -> Column:
    """Characters of the longest prefix with at most ``budget`` tokens.

    One more character can save tokens, so the prefix may go on after a shorter one that has
    more. ``F.substring(text, 1, n)`` is the truncated text. NULL where an argument is NULL or
    the budget is negative.
    """
    return _cut_at(steps, budget)


def within_budget(counts: DataFrame, budget: int) -> DataFrame:
    """``prefix_counts`` judged by a budget: doc_id, n_bytes, n_tokens, over_limit, fit_chars.

    ``over_limit`` tells whether the whole text has more tokens, ``fit_chars`` is the number of
    characters of its longest prefix that has not.
    """
    return counts.select(
        "doc_id",
        "n_bytes",
        "n_tokens",
        (F.col("n_tokens") > budget).alias("over_limit"),
        longest_prefix(F.col("prefix_steps"), F.lit(budget)).alias("fit_chars"),
    )
