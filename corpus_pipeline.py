"""Corpus pipeline over ``documents``: five filters and transforms in a row.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame, which is written as Parquet and read again as the
next one's docs.  All but the last return the columns of documents.

The classifiers learn labels from the same rows as op4 and op5; every
stage's statistics come from the documents that its predecessor kept.

Defined cases: every stage takes an empty table and gives one; null and empty
texts pass the classifiers by the score of a text that says nothing, are no
near-duplicate, and are packed as their end id alone; without labelled rows
of both classes nothing is rejected; rows without an id stay; rows that share
an id are told apart by their texts; other columns pass through to the last
stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.llm.minmax_dedup import near_duplicates
from revlens.llm.packing import best_fit_packing
from revlens.llm.prefix import ranked
from revlens.llm.registry import BYTE_BPE, labelled_rows
from revlens.llm.span_dedup import span_dedup
from revlens.llm.tables import cut, prepare, table
from revlens.llm.toxicity import toxicity_scores
from revlens.llm.zstd_quality import quality_scores
from revlens.session import scratch_path


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is under 0.5."""
    prepare(spark)
    score = toxicity_scores(docs, labelled_rows(table(spark, sf_dir, "labels"), "toxic", 5, 0))
    return docs.withColumn("__score", score).where("__score < 0.5").drop("__score")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is at least 0.7, or that can't be scored
    as no curve could be fitted."""
    prepare(spark)
    score = quality_scores(docs, labelled_rows(table(spark, sf_dir, "labels"), "quality", 4, 2))
    return docs.withColumn("__score", score).where("__score is null or __score >= 0.7").drop("__score")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every near-duplicate class (five words, 0.8), the first.

    Where ids repeat, the rows are numbered in the order of id and text and
    decided one by one, so a text is never lost through another of its id.
    """
    prepare(spark)
    known = docs.where("doc_id is not null")
    if _repeats(known):
        known = ranked(known, ["doc_id", F.xxhash64("text"), "text"], "__row", cut)
    else:
        known = known.withColumn("__row", F.col("doc_id"))
    rows = known.select(F.col("__row").alias("doc_id"), "text")
    gone = near_duplicates(rows, words=5, percent=80).where("not kept").select(F.col("doc_id").alias("__row")).distinct()
    kept = known.join(gone, "__row", "left_anti").select(*docs.columns)
    return kept.unionByName(docs.where("doc_id is null"))


def _repeats(docs: DataFrame) -> bool:
    """Whether some id stands in more than one row."""
    return not docs.groupBy("doc_id").count().where("count > 1").isEmpty()


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the runs of sentences that an earlier one has."""
    prepare(spark)
    cleaned = span_dedup(docs).drop("n_sentences", "n_removed")
    return cleaned.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all token pieces in sequences of 1024."""
    prepare(spark)
    return best_fit_packing(docs, public_tokenizers.path(BYTE_BPE))


STAGES = [
    ("toxicity", toxicity),
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("packing", packing),
]

#: Trained scores and tokenizer ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
