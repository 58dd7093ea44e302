"""Documents to packed sequences: rules, exact and near duplicates, repeated passages, packing.

Each stage takes what its predecessor kept and hands on whole documents; the last one returns
the pieces of the packed sequences.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tradewind.llm.exact import ExactDuplicates
from tradewind.llm.packing import pack
from tradewind.llm.quality import accepted
from tradewind.llm.repeats import without_repeats
from tradewind.llm.simhash import representatives
from tradewind.operators.scratch import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are no outliers of their language and source."""
    return accepted(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest doc_id."""
    return ExactDuplicates(docs).unique()


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts linked by SimHash fingerprints of three-word shingles that differ in at most three bits, the one with the smallest doc_id."""
    return representatives(docs, width=3, distance=3)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes of 100-byte strings that start earlier too; n_chars follows the text."""
    shorter = without_repeats(docs)
    if "n_chars" in docs.columns:
        n_chars = F.length("text").cast(docs.schema["n_chars"].dataType)
        shorter = shorter.withColumn("n_chars", F.when(F.col("text").isNotNull(), n_chars).otherwise(F.col("n_chars")))
    return shorter


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 tokens, with their ids."""
    pieces = pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1, length=2048)
    return pieces.withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_dedup),
    ("near dedup", near_dedup),
    ("repeated passages", repeated_passages),
    ("packing", packing),
]

ORACLE_SQL = None  # outlier estimates, fingerprints and token ids are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents; each but the last is stored before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
