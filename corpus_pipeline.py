"""The corpus pipeline: documents in, packed training sequences out.

Each stage works on what the one before has kept and returns the columns of documents; the last
one returns packed pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heartwood.llm import line_dedup, minhash_dedup, packing, suffix_dedup, toxicity
from heartwood.llm.common import store


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine, trained on the labelled ones, scores below one
    half."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    machine = toxicity.train(store(toxicity.labelled_rows(docs, labels)))
    return toxicity.score(docs, machine).where("toxicity < 0.5").drop("toxicity")


def without_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that ten of them or more share; a missing text becomes empty."""
    rest = [c for c in docs.columns if c not in ("doc_id", "text", "n_chars")]
    kept = line_dedup.drop_common_lines(docs, min_docs=10, carry=tuple(rest))
    return _as_documents(kept, docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return minhash_dedup.without_near_duplicates(docs)


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of 200 bytes or more that occur elsewhere too."""
    rest = [c for c in docs.columns if c not in ("text", "n_chars")]
    kept = suffix_dedup.remove_repeats(docs, carry=tuple(rest), as_text=True)
    return _as_documents(kept, docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, placed in sequences of 4096 tokens."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=4096, end=1)


def _as_documents(kept: DataFrame, docs: DataFrame) -> DataFrame:
    return kept.withColumns(
        {"text": F.col("kept"), "n_chars": F.length("kept").cast("long")}
    ).select(*docs.columns)


STAGES = [
    ("toxicity", without_toxic),
    ("line dedup", without_common_lines),
    ("minhash near-dedup", without_near_copies),
    ("suffix-array dedup", without_repeated_passages),
    ("best-fit packing", packed),
]

#: a trained machine and a tokenizer have no SQL form; tests compare with a brute-force version
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
