"""Cleaning of a training corpus: toxic documents, repeated lines, near-duplicates and benchmark passages go, the rest is tokenised.

Each stage takes (spark, docs, sf_dir) and returns a frame; ``run`` writes it as Parquet to the shared folder and hands the written
rows to the next stage. All stages but the last return the columns of ``documents``.

Null or empty texts pass every stage. A table without rows gives one without rows. Further columns of the documents are kept up to
the last stage.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from platewise.llm import op5_decontaminate, op6_near_duplicates, op7_line_dedup, op8_byte_bpe, op9_toxicity
from platewise.workspace import materialise

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.5 or more go."""
    return op9_toxicity.remove_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of like lines one stays; documents of which nothing is left go."""
    return op7_line_dedup.deduplicate(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest doc_id stays."""
    return op6_near_duplicates.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go if a twentieth or more of their words lies in benchmark passages."""
    return op5_decontaminate.remove_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document, and whether they decode to its text."""
    path, pattern = public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN
    return op8_byte_bpe.encode_checked(docs.select("doc_id", "text"), path, pattern).select(
        "doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), "round_trip"
    )


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("byte_bpe", byte_bpe),
]

# A trained model, SimHash and MinHash candidates and byte-pair merges are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
