"""Rules that hold at any size: stale tables, joins on ids, empty inputs, ids."""

import json
import os

import pytest
from pyspark.sql import functions as F

from revlens.models import candidates as cand
from revlens.operators import naive_bayes as nb, profile, sampling
from revlens.plans import jobs
from revlens.plans.queries import QUERIES

A, B = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def test_catalog_table_follows_the_folder(spark):
    counts = [sum(r.count_sentiment for r in QUERIES["catalog_count_by_sentiment"](spark, d).collect())
              for d in (A, B, A)]
    assert counts[0] == counts[2] < counts[1]


def test_split_joins_nothing_by_id(spark):
    df = spark.range(3000).select("id", F.lit("a").alias("g"), (F.col("id") % 3).alias("label"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        k = sampling.hash_histogram(df, ["g"], "id")
        out = sampling.flag_first_rows(k, F.lit(1000), rank_limit=20)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "Exchange hash" not in plan and "Window" not in plan
        assert out.where("_selected").count() == 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_empty_input(spark):
    none = spark.createDataFrame([], "id long, sentiment int, product_category string, tokens array<string>")
    assert profile.crosscount(none).collect() == []
    model = nb.fit_naive_bayes(none)
    assert model.long_weights().collect() == []
    some = spark.createDataFrame([(1, ["a"])], "id long, tokens array<string>")
    assert [r.prediction for r in nb.predict_naive_bayes(model, some).collect()] == [None]


def test_string_labels(spark):
    rows = [(1, "neg", ["bad", "bad", "x"]), (2, "pos", ["good", "good", "x"])]
    df = spark.createDataFrame(rows, "id long, sentiment string, tokens array<string>")
    model = nb.fit_naive_bayes(df)
    assert {(r.token, r.sentiment, r.token_count) for r in model.long_weights().collect()} == {
        (t, s, {"bad": {"neg": 2}, "good": {"pos": 2}, "x": {"neg": 1, "pos": 1}}[t].get(s, 0))
        for t in ("bad", "good", "x") for s in ("neg", "pos")}
    assert {r.id: r.prediction for r in nb.predict_naive_bayes(model, df).collect()} == {1: "neg", 2: "pos"}


def test_winning_naive_bayes_is_saved_and_scores(spark, tmp_dir):
    rows = [(i, y, f"{'awful' if y < 0 else 'lovely'} thing number {i % 3}") for i in range(12) for y in (-1, 1)]
    df = spark.createDataFrame([(n, y, t) for n, (i, y, t) in enumerate(rows)], "id long, sentiment int, review_body string")
    from revlens.operators.text import with_tokens
    best = cand.best_result([cand.CandidateResult("ngram_lr", 0.5, None),
                             cand.CandidateResult("naive_bayes", 0.9, nb.fit_naive_bayes(with_tokens(df)))])
    again = cand.load_candidate(spark, cand.save_candidate(best, os.path.join(tmp_dir, "model")))
    assert again.name == "naive_bayes"
    scored = cand.score_with_candidate(again, df).collect()
    assert all(r.prediction == (-1 if "awful" in r.review_body else 1) for r in scored)


def test_leaderboard_ties_go_to_the_smaller_name():
    results = [cand.CandidateResult(n, 0.5, None) for n in ("ab", "a", "b")] + [cand.CandidateResult("c", None, None)]
    assert cand.best_result(results).name == "a"


def test_row_ids_do_not_depend_on_the_files(spark, tmp_dir):
    df = spark.createDataFrame([(i % 40, f"text {i % 40}", None if i % 5 else "c") for i in range(120)],
                               "sentiment int, review_body string, product_category string")
    ids = [sorted(r.id for r in jobs.with_row_id(d, os.path.join(tmp_dir, f"rows{n}")).collect())
           for n, d in enumerate((df.repartition(7), df.coalesce(1).orderBy(F.rand(3))))]
    assert ids[0] == ids[1] and len(set(ids[0])) == 120


def test_bias_job_takes_every_facet_and_the_title(spark, tmp_dir):
    rows = [(y, "t", c, z) for y in (0, 1) for c in "ab" for z in "pq" for _ in range(3 + y + (c == "a"))]
    clean = os.path.join(tmp_dir, "clean")
    spark.createDataFrame(rows, "sentiment int, review_body string, product_category string, shop string").write.option(
        "header", True).csv(clean)
    config = {"label": "sentiment", "label_values_or_threshold": [1], "headers": ["sentiment", "shop"],
              "facet": [{"name_or_index": "product_category"}, {"name_or_index": "shop"}],
              "methods": {"pre_training_bias": {"methods": ["CI"]}, "report": {"name": "r", "title": "My title"}}}
    path = os.path.join(tmp_dir, "config.json")
    with open(path, "w") as f:
        json.dump(config, f)
    out = jobs.bias_job(spark, clean, os.path.join(tmp_dir, "out"), path)
    report = spark.read.json(out["bias_balanced"])
    assert {r.title for r in report.collect()} == {"My title"}
    balanced = spark.read.option("header", True).csv(out["balanced_csv"])
    assert {r["count"] for r in balanced.groupBy("sentiment", "product_category", "shop").count().collect()} == {3}
    assert spark.read.json(out["crosscount_balanced"] + "/shop").count() == 4
    config["headers"] = ["absent"]
    with open(path, "w") as f:
        json.dump(config, f)
    with pytest.raises(ValueError, match="absent"):
        jobs.bias_job(spark, clean, os.path.join(tmp_dir, "out2"), path)
