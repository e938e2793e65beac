"""The registered queries of this package and their DuckDB SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorflow.llm import (
    bpe,
    fingerprints,
    language,
    lm_scoring,
    near_dedup,
    packing,
    pieces,
    quality,
    resampling,
    secrets,
    spelling,
    topk,
    toxicity,
)
from sensorflow.llm.common import id_remainder, labelled_sample, table

BPE_FILE = public_tokenizers.path("byte_bpe_50k.json")
RANKS_FILE = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECES_FILE = public_tokenizers.path("piece_bpe_32k.model")


#: Contract values: modulus and held-out remainder of the id's crc32, threshold.
TOXIC_FOLD, TOXIC_AT = (4, 2), 0.3
QUALITY_FOLD, QUALITY_AT = (3, 1), 0.5
LANGUAGE_FOLD = (4, 2)


def toxicity_model(spark: SparkSession, sf_dir: str) -> toxicity.Model:
    sample = labelled_sample(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"),
        "toxic", *TOXIC_FOLD, toxicity.TRAIN_ROWS,
    )
    return toxicity.fit(sample)


def quality_model(spark: SparkSession, sf_dir: str) -> quality.Network:
    sample = labelled_sample(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"),
        "quality", *QUALITY_FOLD, quality.TRAIN_ROWS,
    )
    return quality.fit(sample)


def _scored(docs: DataFrame, fold: tuple[int, int], at: float) -> DataFrame:
    mod, held_out = fold
    return docs.select(
        "doc_id",
        (id_remainder(F.col("doc_id"), mod) == held_out).alias("held_out"),
        "score",
        (F.col("score") >= at).cast("int").alias("predicted"),
    )


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score_documents(docs, toxicity_model(spark, sf_dir))
    return _scored(scored, TOXIC_FOLD, TOXIC_AT)


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_documents(table(spark, sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.score_documents(docs, quality_model(spark, sf_dir))
    return _scored(scored, QUALITY_FOLD, QUALITY_AT)


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    mod, held_out = LANGUAGE_FOLD
    out = id_remainder(F.col("doc_id"), mod) == held_out
    learned = language.fit(language.training_sample(docs, ~out))
    found = language.identify_documents(docs.select("doc_id", "text"), learned)
    return found.select("doc_id", out.alias("held_out"), "lang_pred", "score")


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = table(spark, sf_dir, "labels").where("quality = 1")
    return lm_scoring.score_documents(table(spark, sf_dir, "documents"), good)


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 20 == 0)


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(table(spark, sf_dir, "documents"), BPE_FILE)


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), BPE_FILE)


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_documents(table(spark, sf_dir, "documents"), RANKS_FILE)


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_documents(table(spark, sf_dir, "documents"), PIECES_FILE)


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_fingerprints": op2_fingerprints,
    "op3_quality": op3_quality,
    "op4_language": op4_language,
    "op5_lm_scoring": op5_lm_scoring,
    "op6_topk": op6_topk,
    "op7_bpe": op7_bpe,
    "op8_near_dedup": op8_near_dedup,
    "op9_packing": op9_packing,
    "op10_secrets": op10_secrets,
    "op11_spelling": op11_spelling,
    "op12_resampling": op12_resampling,
    "op13_sentencepiece": op13_sentencepiece,
}

ORACLE: dict[str, str] = {
    "op6_topk": """
        WITH points AS (
            SELECT DISTINCT CAST(vec_id AS BIGINT) AS vec_id,
                   list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   max(CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT)) AS score
            FROM points q JOIN points c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
            WHERE q.vec_id % 20 = 0
            GROUP BY ALL
        ), ranked AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
            FROM scored
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
    """,
}
