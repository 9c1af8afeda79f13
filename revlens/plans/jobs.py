"""End-to-end jobs over review files, one per stage of the workflow.

Each job reads its inputs with Spark, writes every result next to the
others under ``output`` (any Hadoop URI) and returns a dict of the written
paths.  The plot-ready tables are the outputs; nothing is drawn.

profile_job   raw review CSV -> clean CSV -> catalog table -> SQL profile
bias_job      clean CSV -> bias report -> balanced CSV -> bias report again
train_job     balanced CSV -> training text (train/validation) -> candidate
              leaderboard -> best candidate -> scored sample reviews
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F

from revlens.models import candidates as cand
from revlens.operators import bias, cleaning, profile, sampling, text
from revlens.plans import sql as sql_plans
from revlens.sources import catalog
from revlens.sources.config import BiasConfig, read_bias_config
from revlens.sources.csv_io import (
    read_clean_reviews, read_raw_reviews, write_clean_csv, write_labelled_text,
    write_training_projection,
)


def _path(output: str, name: str) -> str:
    return output.rstrip("/") + "/" + name


def _write_json(df: DataFrame, path: str) -> str:
    df.coalesce(1).write.mode("overwrite").json(path)
    return path


def with_row_id(df: DataFrame, path: str) -> DataFrame:
    """Rows with an ``id`` from their content, written once under ``path``.

    The id hashes every column and, for equal rows, a running number.  Equal
    rows are counted (partial aggregation) and spread out again, so the ids
    depend neither on the files' packing nor on the order of the rows.
    """
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_times"))
    numbered = counted.withColumn("_tie", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_times"))))
    numbered.select(F.xxhash64(*df.columns, "_tie").alias("id"), *df.columns).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def profile_job(spark: SparkSession, raw_path: str, output: str,
                database: str = "review_analytics", table: str = "reviews") -> dict:
    out = {}
    raw = read_raw_reviews(spark, raw_path)
    clean = cleaning.clean_raw_reviews(raw)
    out["clean_csv"] = _path(output, "clean")
    write_clean_csv(clean, out["clean_csv"])
    catalog.create_database(spark, database, _path(output, f"{database}.db"))
    full = catalog.register_csv_table(spark, database, table, out["clean_csv"])
    out["table"] = full
    for name in ("count_by_sentiment", "count_sentiment_by_category",
                 "avg_sentiment_by_category", "count_reviews_by_category",
                 "count_by_category_sentiment"):
        out[name] = _write_json(sql_plans.run_statement(spark, name, full), _path(output, name))
    reviews = spark.table(full)
    breakdown = sql_plans.run_statement(spark, "count_by_category_sentiment", full)
    out["sentiment_totals"] = _write_json(profile.sentiment_totals(breakdown),
                                          _path(output, "sentiment_totals"))
    out["sentiment_pct_by_category"] = _write_json(profile.sentiment_pct_by_category(reviews),
                                                   _path(output, "sentiment_pct_by_category"))
    out["max_category_count"] = _write_json(profile.max_category_count(reviews),
                                            _path(output, "max_category_count"))
    words = sql_plans.run_statement(spark, "num_words", full)
    out["word_count_describe"] = _write_json(profile.describe(words), _path(output, "word_count_describe"))
    out["word_count_histogram"] = _write_json(profile.histogram(words), _path(output, "word_count_histogram"))
    return out


def bias_job(spark: SparkSession, clean_path: str, output: str,
             config_path: str | None = None, seed: int = 42) -> dict:
    out = {}
    cfg = read_bias_config(spark, config_path) if config_path else BiasConfig(
        label="sentiment", positive_values=[1], facets=["product_category"],
        methods=list(bias.ALL_METHODS))
    clean = with_row_id(read_clean_reviews(spark, clean_path), _path(output, "rows/clean"))
    missing = [h for h in cfg.headers if h not in clean.columns]
    if missing:
        raise ValueError(f"headers of the configuration that the data lacks: {missing}")

    def crosscounts(df: DataFrame, name: str) -> str:
        """Per facet, under the facet's name when there are several."""
        for facet in cfg.facets:
            at = name if len(cfg.facets) == 1 else f"{name}/{facet}"
            _write_json(profile.crosscount(df, facet, cfg.label), _path(output, at))
        return _path(output, name)

    def report(df: DataFrame, name: str) -> str:
        found = bias.bias_report_from_config(df, cfg)
        return _write_json(found.withColumn("title", F.lit(cfg.report_title)), _path(output, name))

    out["crosscount_unbalanced"] = crosscounts(clean, "crosscount/unbalanced")
    out["bias_unbalanced"] = report(clean, "bias/unbalanced")
    # Every combination of the facets' values and the label gets equally many rows.
    balanced = sampling.balance_by_downsampling(clean, (*cfg.facets, cfg.label), "id", seed)
    out["balanced_csv"] = _path(output, "balanced")
    write_clean_csv(balanced.drop("id"), out["balanced_csv"])
    rebalanced = read_clean_reviews(spark, out["balanced_csv"])
    out["crosscount_balanced"] = crosscounts(rebalanced, "crosscount/balanced")
    out["bias_balanced"] = report(rebalanced, "bias/balanced")
    return out


def train_job(spark: SparkSession, balanced_path: str, output: str, seed: int = 42,
              test_size: float = 0.1, candidates=None, max_candidates: int = 3,
              target: str = "sentiment") -> dict:
    out = {}
    rows = read_clean_reviews(spark, balanced_path)
    if target != "sentiment":
        rows = rows.drop("sentiment").withColumnRenamed(target, "sentiment")
    df = with_row_id(rows.where(F.col("sentiment").isNotNull()), _path(output, "rows/balanced"))
    out["projection_csv"] = _path(output, "projection")
    write_training_projection(df, out["projection_csv"])
    split = sampling.stratified_split(df, "sentiment", test_size, "id", seed)
    out["split_sizes"] = _write_json(profile.split_sizes(split), _path(output, "split_sizes"))
    prepared = text.prepare_training_rows(split)
    for part in ("train", "validation"):
        out[f"{part}_text"] = _path(output, f"text/{part}")
        write_labelled_text(prepared.where(F.col("split") == part), out[f"{part}_text"], prefixed=True)
    train = split.where(F.col("split") == "train")
    validation = split.where(F.col("split") == "validation")
    results = cand.fit_candidates(train, validation, candidates, max_candidates=max_candidates)
    out["leaderboard"] = _write_json(cand.leaderboard(spark, results), _path(output, "leaderboard"))
    best = cand.best_result(results)
    out["model"] = cand.save_candidate(best, _path(output, "model"))
    samples = spark.createDataFrame([(i, t) for i, t in enumerate(text.SAMPLE_SCORING_REVIEWS)],
                                    "id bigint, review_body string")
    out["scores"] = _write_json(cand.score_with_candidate(best, samples), _path(output, "scores"))
    return out


def main(argv=None) -> None:
    import argparse
    import json

    from revlens.session import local_session
    p = argparse.ArgumentParser(prog="python -m revlens")
    sub = p.add_subparsers(dest="job", required=True)
    a = sub.add_parser("profile", help="raw CSV -> clean CSV, table, SQL profile")
    a.add_argument("raw"), a.add_argument("output")
    b = sub.add_parser("bias", help="clean CSV -> bias reports and balanced CSV")
    b.add_argument("clean"), b.add_argument("output"), b.add_argument("--config")
    c = sub.add_parser("train", help="balanced CSV -> training text, candidates, model, scores")
    c.add_argument("balanced"), c.add_argument("output")
    c.add_argument("--max-candidates", type=int, default=3), c.add_argument("--target", default="sentiment")
    p.add_argument("--master", default=os.environ.get("REVLENS_MASTER", "local[*]"))
    args = p.parse_args(argv)
    if args.master.startswith("local"):
        spark = local_session(cpus=args.master[6:-1] or "*")
    else:
        spark = SparkSession.builder.master(args.master).appName("revlens").getOrCreate()
    if args.job == "profile":
        res = profile_job(spark, args.raw, args.output)
    elif args.job == "bias":
        res = bias_job(spark, args.clean, args.output, args.config)
    else:
        res = train_job(spark, args.balanced, args.output, max_candidates=args.max_candidates,
                        target=args.target)
    print(json.dumps(res, indent=2))
    spark.stop()
