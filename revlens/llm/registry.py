"""Registered queries of the numbered operators, and SQL where it can say them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.llm.attention_lm import lm_scores
from revlens.llm.minmax_dedup import near_duplicates
from revlens.llm.mixing import mix_sources
from revlens.llm.oracles import ORACLE_SQL  # noqa: F401 - read by the entry module
from revlens.llm.packing import best_fit_packing
from revlens.llm.resampling import importance_resample
from revlens.llm.sentencepiece_fst import encode_documents
from revlens.llm.simhash import document_fingerprints
from revlens.llm.span_dedup import span_dedup
from revlens.llm.spelling import spelling_variants
from revlens.llm.tables import table
from revlens.llm.token_counts import token_counts
from revlens.llm.topk import top_k
from revlens.llm.toxicity import toxicity_scores
from revlens.llm.zstd_quality import quality_scores

BYTE_BPE = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"


def op1_minmax_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), words=2, percent=80)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return span_dedup(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_sentences", "n_removed")


def op3_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return top_k(vectors, is_query=F.col("vec_id") % 100 == 0, k=10)


def _split(ids: str, folds: int, out: int) -> F.Column:
    """Whether crc32 of the id as text falls in the fold that isn't learned from."""
    return F.coalesce(F.crc32(F.col(ids).cast("string")) % folds == out, F.lit(False))


def _scored(df: DataFrame, score: F.Column, folds: int, out: int, least: float) -> DataFrame:
    return (df.select("doc_id", _split("doc_id", folds, out).alias("held_out"), score.alias("score"))
            .withColumn("predicted", (F.col("score") >= least).cast("int")))


def labelled_rows(labels: DataFrame, column: str, folds: int, out: int) -> DataFrame:
    return labels.where(~_split("doc_id", folds, out)).select("doc_id", F.col(column).alias("label"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    known = labelled_rows(table(spark, sf_dir, "labels"), "toxic", 5, 0)
    return _scored(docs, toxicity_scores(docs, known), 5, 0, 0.5)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    known = labelled_rows(table(spark, sf_dir, "labels"), "quality", 4, 2)
    return _scored(docs, F.coalesce(quality_scores(docs, known), F.lit(0.5)), 4, 2, 0.7)


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_packing(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE))


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return lm_scores(docs, public_tokenizers.path(BYTE_BPE), _split("doc_id", 10, 0))


def op8_sentencepiece_fst(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE), limit=1024)


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_fingerprints(table(spark, sf_dir, "documents")).drop("next_fingerprint")


def op11_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"), weights=(5, 2, 1), percent=100, times=3).shares()


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, wanted = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return importance_resample(docs, wanted, percent=10, min_words=20, buckets=10_000, runs=1, seed=2024).drop("n_words")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"), least=6, least_n=5, every=199, ratio=5)


QUERIES = {f.__name__: f for f in (
    op1_minmax_near_dedup, op2_substring_dedup, op3_exact_top_k, op4_toxicity, op5_quality,
    op6_best_fit_packing, op7_lm_scoring, op8_sentencepiece_fst,
    op9_token_counts, op10_simhash, op11_source_mixing, op12_importance_resampling,
    op13_spelling_variants)}
