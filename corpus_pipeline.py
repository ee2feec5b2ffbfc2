"""Corpus pipeline over documents: each stage is a step (spark, docs, sf_dir) -> DataFrame.

A stage reads all its predecessor kept; what it returns is written as Parquet
below the shared folder and read again as the next stage's documents. All
stages but the last return the columns of documents unchanged.

Edge cases: rows with null or repeated ids pass the first four stages as rows of their own. Of
equal texts with equal ids one row stays. Empty tables give empty stages; an empty benchmark removes nothing. Texts of any length are
read whole, and columns with clashing names pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from telemill.llm import decontamination, exact_dedup, language, minhash_dedup, packing
from telemill.llm.common import stored, table


def with_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language.

    Null texts and those without a letter go, and those that the predicted language has no phrases for,
    such as texts in an unknown script. Without any labelled text only the former go.
    """
    return language.filter(docs, language.sample(docs.filter(~language.held_out())))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the smallest id stays."""
    return exact_dedup.filter(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by 0.8 of their five-word shingles, the document with the smallest id stays."""
    return minhash_dedup.filter(docs, words=5, percent=80)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage, plain or re-parameterised."""
    return decontamination.filter(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents that are left, with their sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("language id", with_language),
    ("exact dedup", without_copies),
    ("near dedup", without_near_copies),
    ("decontamination", without_benchmark),
    ("packing", packed),
]

#: SQL cannot express the automata, the signatures, the tokenizer or the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
