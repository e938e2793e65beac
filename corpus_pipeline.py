"""The corpus pipeline: documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
every stage's result as Parquet in the folder that ``spark.checkpoint.dir``
names and reads it back for the next.

Odd rows: a null text counts as empty in every stage. The toxicity stage keeps a
document below the threshold, so empty texts go or stay by the model's bias; the
quality stage scores them with the share of label 1; all empty texts are one class
of near duplicates, of which one row stays; nulls stay null through the secret
scans; packing gives them the end id alone. Null ids and repeated rows are
documents like any others until near duplicates are merged (the smallest id stays,
null only if there is no other). Extra columns stay until packing, whatever their
names. Without labels both classifiers are constant: toxicity and quality scores
are 0.5, so toxicity rejects everything at its threshold of 0.3. Empty tables go
through as empty tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorflow.llm import near_dedup, packing, quality, secrets, toxicity
from sensorflow.llm.common import table
from sensorflow.llm.queries import (
    BPE_FILE,
    QUALITY_AT,
    RANKS_FILE,
    TOXIC_AT,
    quality_model,
    toxicity_model,
)
from sensorflow.session import scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the toxicity threshold stay."""
    scored = toxicity.score_documents(docs, toxicity_model(spark, sf_dir), SCORE)
    return scored.where(F.col(SCORE) < TOXIC_AT).select(docs.columns)


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored at the quality threshold or above stay."""
    scored = quality.score_documents(docs, quality_model(spark, sf_dir), SCORE)
    return scored.where(F.col(SCORE) >= QUALITY_AT).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays."""
    return near_dedup.deduplicate(docs)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; its secrets are replaced by a mark."""
    return secrets.redact_documents(docs, RANKS_FILE)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences."""
    return packing.pack_documents(docs, BPE_FILE)


SCORE = "__score"

STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxic),
    ("quality_classifier", good),
    ("minhash_near_dedup", near_duplicates),
    ("secret_scans", secret_scans),
    ("packing", pack),
]

#: Trained models and tokenizers have no SQL form; tests hold the pipeline
#: against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last stage's rows."""
    folder = scratch_path(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
