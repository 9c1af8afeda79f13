import os

from pyspark.sql import functions as F

from revlens.plans import flows, jobs
from revlens.sources.tables import reviews


def test_profile_bias_train_jobs_chain(spark, tmp_dir):
    raw = flows.write_raw_reviews_csv(spark, reviews(spark, "/root/testdata/sf0.01"),
                                      os.path.join(tmp_dir, "raw"))
    p = jobs.profile_job(spark, raw, os.path.join(tmp_dir, "profile"), database="jobs_db")
    from revlens.sources.csv_io import read_clean_reviews
    assert read_clean_reviews(spark, p["clean_csv"]).count() == 399
    counts = {r.sentiment: r.count_sentiment for r in spark.read.json(p["count_by_sentiment"]).collect()}
    assert counts == {-1: 58, 0: 42, 1: 299}
    assert spark.read.json(p["word_count_histogram"]).count() == 100

    b = jobs.bias_job(spark, p["clean_csv"], os.path.join(tmp_dir, "bias"))
    unb = {r.facet_value: r for r in spark.read.json(b["bias_unbalanced"]).collect()}
    assert round(unb["de"].ci, 6) == 0.769424
    from revlens.sources.csv_io import read_clean_reviews
    assert read_clean_reviews(spark, b["balanced_csv"]).count() == 24
    for r in spark.read.json(b["bias_balanced"]).collect():
        assert abs(r.ks) < 1e-12 and abs(r.tvd) < 1e-12

    t = jobs.train_job(spark, p["clean_csv"], os.path.join(tmp_dir, "train"),
                       candidates=["ngram_lr", "naive_bayes"])
    sizes = {r.split: r.n_rows for r in spark.read.json(t["split_sizes"]).collect()}
    assert sizes == {"train": 359, "validation": 40}
    lines = spark.read.text(t["train_text"])
    assert lines.count() == 359 and lines.where(~F.col("value").startswith("__label__")).count() == 0
    assert spark.read.json(t["leaderboard"]).count() == 2
    scores = spark.read.json(t["scores"]).collect()
    assert len(scores) == 3 and all(s.sentiment_name in ("Negative", "Neutral", "Positive") for s in scores)
