import os

import pytest
from pyspark.sql import functions as F

from revlens.plans import flows, sql as sql_plans
from revlens.sources import catalog


def test_catalog_ddl_and_sql(spark, tmp_dir):
    df = spark.createDataFrame([(1, "a, b", "x"), (-1, 'say "hi"\nthere', "x"), (None, "c", "y")],
                               "sentiment int, review_body string, product_category string")
    path = os.path.join(tmp_dir, "tbl")
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    catalog.create_database(spark, "rev_db")
    catalog.create_database(spark, "rev_db")  # idempotent
    assert "rev_db" in [r[0] for r in catalog.list_databases(spark).collect()]
    full = catalog.register_csv_table(spark, "rev_db", "reviews", path)
    full = catalog.register_csv_table(spark, "rev_db", "reviews", path)  # overwrite
    desc = {r.col_name: r.data_type for r in catalog.describe_table(spark, full).collect()}
    assert desc["sentiment"] == "int" and desc["review_body"] == "string"
    got = {r.sentiment: r.count_sentiment for r in
           sql_plans.run_statement(spark, "count_by_sentiment", full).collect()}
    assert got == {1: 1, -1: 1, None: 0}
    words = sorted(r.num_words for r in sql_plans.run_statement(spark, "num_words", full).collect())
    assert words == [1, 2, 2]


def test_csv_roundtrip_keeps_whole_texts(spark):
    from revlens.sources.tables import load_table
    docs = load_table(spark, "/root/testdata/sf0.001", "documents").select(
        F.col("doc_id").alias("id"), F.lit(1).alias("sentiment"),
        F.col("text").alias("review_body"), F.col("lang").alias("product_category"))
    back = flows.csv_roundtrip(spark, docs, "docs")
    assert back.count() == docs.count()
    assert back.exceptAll(docs).count() == 0


@pytest.fixture(scope="module")
def split(spark):
    from revlens.plans.datasets import clean_fixture_reviews
    from revlens.operators.sampling import stratified_split
    s = stratified_split(clean_fixture_reviews(spark, "/root/testdata/sf0.01"))
    return s.where("split = 'train'"), s.where("split = 'validation'")


def test_pipeline_fit_score_save_load(spark, split, tmp_dir):
    from pyspark.ml import PipelineModel
    from revlens.models import candidates as cand
    train, validation = split
    model = cand.ngram_lr_pipeline(num_features=1 << 12, max_iter=5).fit(cand.with_label(train))
    scored = cand.score_reviews(model, validation.select("id", "review_body"))
    assert scored.columns == ["id", "review_body", "prediction", "sentiment_name", "probability"]
    rows = scored.collect()
    assert len(rows) == validation.count()
    assert all(r.prediction in (-1, 0, 1) and abs(sum(r.probability) - 1) < 1e-9 for r in rows)
    path = os.path.join(tmp_dir, "model")
    model.write().overwrite().save(path)
    again = PipelineModel.load(path)
    a = {r.id: r.prediction for r in scored.collect()}
    b = {r.id: r.prediction for r in cand.score_reviews(again, validation.select("id", "review_body")).collect()}
    assert a == b


def test_leaderboard_order(spark):
    from revlens.models.candidates import CandidateResult, leaderboard
    res = [CandidateResult("b", 0.5, None), CandidateResult("a", 0.9, None), CandidateResult("c", 0.5, None)]
    rows = leaderboard(spark, res).collect()
    assert [(r["rank"], r.candidate_name) for r in rows] == [(1, "a"), (2, "b"), (3, "c")]


def test_stream_scoring_available_now(spark, split, tmp_dir):
    from revlens.models import candidates as cand
    from revlens.streaming.scoring import review_stream, start_scoring
    train, validation = split
    model = cand.ngram_lr_pipeline(num_features=1 << 12, max_iter=5).fit(cand.with_label(train))
    src = os.path.join(tmp_dir, "incoming")
    validation.select("id", "review_body").write.mode("overwrite").parquet(src)
    stream = review_stream(spark, src, "id bigint, review_body string")
    q = start_scoring(model, stream, os.path.join(tmp_dir, "sink"), os.path.join(tmp_dir, "ckpt"))
    q.awaitTermination()
    out = spark.read.parquet(os.path.join(tmp_dir, "sink"))
    assert out.count() == validation.count()
    batch = {r.id: r.prediction for r in cand.score_reviews(model, validation).collect()}
    assert {r.id: r.prediction for r in out.collect()} == batch


def test_tune_ngram_lr_grid(spark, split):
    from revlens.models import candidates as cand
    train, _ = split
    model = cand.tune_ngram_lr(train, reg_params=(0.0, 0.1), num_features=1 << 10)
    assert len(model.validationMetrics) == 2
    assert all(0.0 <= m <= 1.0 for m in model.validationMetrics)


def test_training_projection_csv_roundtrip(spark, tmp_dir):
    from revlens.sources.csv_io import read_clean_reviews, write_training_projection
    df = spark.createDataFrame([(1, 'fine, "really"\nyes', "x"), (-1, "bad", "y")],
                               "sentiment int, review_body string, product_category string")
    path = os.path.join(tmp_dir, "projection")
    write_training_projection(df, path)
    back = read_clean_reviews(spark, path)
    assert back.columns == ["sentiment", "review_body"]
    assert sorted(back.collect()) == sorted(df.select("sentiment", "review_body").collect())
