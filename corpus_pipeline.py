"""A corpus pipeline over ``documents``: quality rules, language ID, near-duplicates, packing.

Each stage works on all rows its predecessor kept. The first three drop rows and keep the columns; the last
one gives the packed sequences, one row per piece. Packing and language ID have no SQL form, so
``ORACLE_SQL`` is None; the operators are tested one by one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from floorlens.llm import crf, lsh_forest, packing, quality
from floorlens.session import pin


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current quality policy keeps."""
    return quality.accept(docs)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known."""
    return crf.accept(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, by shingles of five words and a similarity of 0.8."""
    return lsh_forest.accept(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences of at most 2048 tokens."""
    return packing.packed(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("language ID", language_id),
    ("near-duplicates", near_duplicates),
    ("packing", pack),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage keeps is written before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for place, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if place < len(STAGES) - 1:
            docs = pin(docs)
    return docs
