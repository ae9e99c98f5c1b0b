"""A corpus from raw documents: languages, copies, near copies, benchmark leaks, token ids.

Each stage works on all that the one before kept. All but the last return the columns of the
documents they were given. An empty table passes through; what null ids and texts mean is said
where the operators are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wardline.llm import decontaminate, exact_dedup, language, ngram_join, piece_bpe
from wardline.llm.common import read_table
from wardline.session import materialize


def accept_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages that the labels name; text in none of them goes."""
    return language.accepted(docs, language.learn_languages(docs))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest id."""
    return exact_dedup.deduplicate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents connected by near-duplicate links the one with the smallest id."""
    return ngram_join.representatives(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.without_leaks(docs, read_table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded texts."""
    import public_tokenizers

    return piece_bpe.digest_documents(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("language", accept_languages),
    ("exact_dedup", drop_copies),
    ("ngram_join", drop_near_copies),
    ("decontaminate", drop_leaks),
    ("sentencepiece", encode),
]

# Language models, edit distances and tokenizers have no SQL counterpart.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
