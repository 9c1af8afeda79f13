"""The pipeline's stages, against their operators, on a small table."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from revlens.llm import registry

SF = "/root/testdata/sf0.01"


def test_stages_keep_columns_and_clean_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    seen = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, seen = seen, stage(spark, seen, SF).checkpoint()
        assert seen.columns == docs.columns, name
        assert 0.5 * before.count() < seen.count() <= before.count(), name
        if name == "quality":
            kept = seen.join(labels, "doc_id")
            assert kept.where("quality = 1 and toxic = 0").count() >= 0.95 * labels.join(docs, "doc_id").where("quality = 1 and toxic = 0").count()
            assert kept.where("quality = 0").count() <= 0.05 * labels.where("quality = 0").count() + 1
    rows = corpus_pipeline.STAGES[-1][1](spark, seen, SF)
    assert rows.select("doc_id").distinct().count() == seen.count()
    assert rows.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 1024").isEmpty()


def test_near_dedup_keeps_one_of_each(spark):
    text = " ".join(f"word{i}" for i in range(60))
    rows = [(i, text if i < 9 else f"{text} {i} other {i} words", "en", "s", 1) for i in range(10)]
    rows += [(100, "alone here", "en", "s", 1), (100, "alone here", "en", "s", 1), (None, text, "en", "s", 1), (101, None, "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.near_dedup(spark, docs, SF)
    assert sorted((r.doc_id for r in got.collect()), key=str) == [0, 100, 101, None]
    assert got.columns == docs.columns
    assert corpus_pipeline.near_dedup(spark, docs.limit(0), SF).collect() == []


def test_no_text_is_lost_through_a_shared_id(spark):
    a, b = (" ".join(f"{x}{i}" for i in range(40)) for x in "ab")
    rows = [(3, a), (5, a), (5, b), (7, b), (5, "its own text here"), (9, a + " more")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], DOCS)
    got = corpus_pipeline.near_dedup(spark, docs, SF)
    assert sorted((r.doc_id, r.text) for r in got.collect()) == [(3, a), (5, b), (5, "its own text here")]


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def one_class(spark, tmp_path):
    """A folder whose labels are of one class each."""
    rows = [(i, f"plain words number {i} stand here", "en", "s", 30) for i in range(20)]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(20)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


def test_labels_of_one_class_reject_nothing(spark, one_class):
    docs = spark.read.parquet(f"{one_class}/documents.parquet")
    for stage in (corpus_pipeline.toxicity, corpus_pipeline.quality):
        assert stage(spark, docs, one_class).count() == 20
    assert {(r.score, r.predicted) for r in registry.op5_quality(spark, one_class).collect()} == {(0.5, 0)}


def test_stages_on_edges_and_empty_tables(spark, edges):
    """Nulls, empty texts, repeated ids, rows without an id, other columns."""
    docs = edges.withColumn("source", F.lit("s")).withColumn("n_chars", F.char_length("text").cast("long"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, SF)
        assert got.columns == docs.columns, name
        assert {r.doc_id for r in got.collect()} <= {r.doc_id for r in docs.collect()}
        assert got.where("doc_id is null").count() == 1, name
        assert stage(spark, docs.limit(0), SF).collect() == []
    packed = corpus_pipeline.packing(spark, docs, SF)
    assert packed.where("doc_id = 1").select("length").collect()[0][0] == 1
    assert corpus_pipeline.packing(spark, docs.limit(0), SF).collect() == []
