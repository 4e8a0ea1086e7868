"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet to the shared
folder and read again as the next stage's documents. All but the last keep the columns of
``documents``. Rows with nulls, empty texts or ids that repeat go through every stage; what
becomes of them is stated by the operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sievework.llm import jaccard_join, language_id, mixing, packing, substring_dedup
from sievework.llm.common import cut, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can't be told go."""
    return language_id.accepted(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that five-word shingles link at a Jaccard similarity of 0.8, the one with the smallest id stays."""
    return jaccard_join.one_of_each(docs, n=5, threshold=(8, 10))


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words inside passages of 35 words or more that stand elsewhere too are taken out."""
    return substring_dedup.without_repeats(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are taken up to their targets, repeated or dropped, and put in training order."""
    return mixing.mixture(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of power-of-two lengths, each a sequence of its own."""
    return packing.pack(docs, with_ids=False)


STAGES = [
    ("language_id", identify_language),
    ("ngram_jaccard", drop_near_duplicates),
    ("substring_dedup", drop_repeated_passages),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Naive Bayes, FM-indexes and tokenizers aren't SQL; tests/llm holds run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
