"""The corpus pipeline: documents through five operators, each stage on what the one before kept.

Stages keep the columns of documents (the last returns packed pieces) and are whole in themselves:
`run` writes each stage's result as a table and reads it back as the next one's input, so a lost
executor costs a part of one stage. Nulls, empty and long texts, repeated rows and empty tables are
handled as each operator states in its module.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segspark.llm import exact_dedup, near_dedup, packing, repetition, secret_scan
from segspark.session import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the repetition rules reject go."""
    return repetition.repetition_filter(docs)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents equal but for white space, the longest original stays, then the smallest id."""
    return exact_dedup.drop_exact_duplicates(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by five-word shingles at a similarity of 0.8, the smallest id stays."""
    return near_dedup.drop_near_duplicates(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret found is replaced by a mark; no document goes. n_chars follows the new text."""
    redacted = secret_scan.redact(docs)
    return redacted.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of every document, with their ids, in sequences of 2048."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), with_ids=True)


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_duplicates),
    ("near dedup", near_duplicates),
    ("secret scans", secrets),
    ("packing", packed),
]

#: Tokenization has no SQL form; tests hold the result against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs)
    return docs
