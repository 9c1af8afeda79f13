import re

import duckdb

import __spark_entry__ as E
from tools.oracle_check import TABLES, norm

SF = "/root/testdata/sf0.001"

# Keys without an oracle: model training, model comparison and streaming.
ROWS_ONLY = {"train_text_classifier", "training_metrics", "candidate_leaderboard",
             "best_candidate", "score_reviews", "stream_score_reviews",
             "train_embedding_classifier", "embedding_training_metrics", "word_count_quantiles",
             "halving_table"}

FAST_KEYS = ["count_by_category_sentiment", "clean_reviews", "bias_report", "balanced_reviews",
             "stratified_split", "word_count_histogram", "tokenize_reviews", "sentiment_totals",
             "nb_predictions", "stage_shapes", "frequent_ngrams", "frequent_tokens",
             "abbreviation_scores", "tokenize_abbreviations", "clean_raw_csv_splits",
             "bias_from_config_groups", "word_count_quantile_errors"]


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["product_category", "sentiment", "count_reviews"]


def test_every_key_has_an_oracle_or_is_declared_rows_only():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    own = {k for k in set(q) - set(o) if k != "pipeline" and not re.match(r"op\d+_", k)}
    assert own == ROWS_ONLY


def test_fast_keys_match_oracle_at_sf0001(spark):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    q, o = E.queries(), E.oracle_sql()
    for key in FAST_KEYS:
        sdf = q[key](spark, SF)
        cols = sorted(sdf.columns)
        s_rows = sorted((tuple(norm(r[c]) for c in cols) for r in sdf.collect()), key=repr)
        rel = con.sql(o[key])
        assert sorted(rel.columns) == cols, key
        idx = [rel.columns.index(c) for c in cols]
        d_rows = sorted((tuple(norm(r[i]) for i in idx) for r in rel.fetchall()), key=repr)
        assert s_rows == d_rows, key
