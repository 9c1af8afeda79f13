"""Registry of named queries: ``name -> f(spark, sf_dir) -> DataFrame``.

Every query reads the whole stand-in tables of ``sf_dir``; the keys match
``oracle_sql.ORACLE_SQL``.  Floating results are rounded to 6 decimals so
that Spark and the DuckDB oracle hash alike.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from revlens.functions.sentiment import rating_to_sentiment
from revlens.models import candidates as cand, embedding, halving
from revlens.operators import abbreviations as abbr, bias, cleaning, frequent, naive_bayes as nb, profile, quantiles, sampling
from revlens.operators import text as text_ops
from revlens.plans import flows, sql as sql_plans
from revlens.plans.datasets import (
    clean_fixture_reviews, clean_order_reviews, fixture_reviews_with_narrow, order_reviews_with_narrow,
)
from revlens.session import ensure_checkpoint_dir
from revlens.sources.csv_io import labelled_lines
from revlens.sources.tables import load_table, order_reviews, reviews

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def register(fn):
        QUERIES[name] = fn
        return fn
    return register


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select([F.round(F.col(c), digits).alias(c) if t in ("double", "float") else F.col(c)
                      for c, t in df.dtypes])


# --------------------------------------------------------------- profiling
@query("count_by_category_sentiment")
def q_count_by_category_sentiment(spark, sf_dir):
    return profile.count_by_category_sentiment(clean_fixture_reviews(spark, sf_dir))


@query("count_by_category_sentiment_orders")
def q_count_by_category_sentiment_orders(spark, sf_dir):
    return profile.count_by_category_sentiment(clean_order_reviews(spark, sf_dir))


def labelled_reviews(spark, sf_dir):
    """Reviews with a rating, sentiment derived, before the rare filter."""
    return cleaning.label_sentiment(cleaning.drop_incomplete(reviews(spark, sf_dir)))


def split_reviews(spark, sf_dir):
    clean, narrow = fixture_reviews_with_narrow(spark, sf_dir)
    return sampling.stratified_split(clean, narrow=narrow)


def balanced(spark, sf_dir):
    clean, narrow = fixture_reviews_with_narrow(spark, sf_dir)
    return sampling.balance_by_downsampling(clean, narrow=narrow)


def split_orders(spark, sf_dir):
    clean, narrow = order_reviews_with_narrow(spark, sf_dir)
    return sampling.stratified_split(clean, narrow=narrow)


def balanced_order_reviews(spark, sf_dir):
    clean, narrow = order_reviews_with_narrow(spark, sf_dir)
    return sampling.balance_by_downsampling(clean, narrow=narrow)


def labelled_orders(spark, sf_dir):
    """Order reviews with a rating and sentiment, before the rare filter."""
    return cleaning.label_sentiment(cleaning.drop_incomplete(
        order_reviews(spark, sf_dir), ("star_rating", "product_category")))


def texts_with_samples(spark, sf_dir):
    """Every document text plus the sample sentences (negative ids): the
    documents hold no apostrophe, so the samples exercise contractions."""
    docs = load_table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"),
                                                          F.col("text").alias("review_body"))
    samples = ([text_ops.SAMPLE_SENTENCE] + [t for _, t in text_ops.SAMPLE_PREPARATION_ROWS]
               + text_ops.SAMPLE_SCORING_REVIEWS)
    extra = spark.createDataFrame([(-(i + 1), s) for i, s in enumerate(samples)],
                                  "id bigint, review_body string")
    return docs.unionByName(extra)


def _counted_reviews(spark, sf_dir):
    from revlens.functions.text import word_count
    return reviews(spark, sf_dir).select("product_category", "fine_category", word_count("review_body").alias("num_words"))


def _word_count_sketches(spark, sf_dir):
    return quantiles.sketch(_counted_reviews(spark, sf_dir), ["product_category", "fine_category"], "num_words")


# ----------------------------------------------------------------- cleaning
@query("rating_to_sentiment")
def q_rating_to_sentiment(spark, sf_dir):
    return reviews(spark, sf_dir).select("id", "star_rating",
                                         rating_to_sentiment("star_rating").alias("sentiment"))


@query("clean_raw_csv")
def q_clean_raw_csv(spark, sf_dir):
    """Raw-layout CSV of every review (written to the shared folder), read
    back with the raw reader and cleaned by the raw -> clean chain."""
    from revlens.session import scratch_path
    from revlens.sources.csv_io import read_raw_reviews
    path = flows.write_raw_reviews_csv(spark, reviews(spark, sf_dir), scratch_path(spark, "raw-csv"))
    return cleaning.clean_raw_reviews(read_raw_reviews(spark, path))


@query("clean_raw_csv_splits")
def q_clean_raw_csv_splits(spark, sf_dir):
    """As clean_raw_csv, each file read by many tasks."""
    from revlens.session import scratch_path
    from revlens.sources.csv_io import read_raw_reviews
    path = flows.write_raw_reviews_csv(spark, reviews(spark, sf_dir), scratch_path(spark, "raw-csv"))
    return cleaning.clean_raw_reviews(read_raw_reviews(spark, path, splittable=True))


@query("clean_reviews")
def q_clean_reviews(spark, sf_dir):
    return clean_fixture_reviews(spark, sf_dir)


@query("rare_category_filter")
def q_rare_category_filter(spark, sf_dir):
    return (cleaning.rare_category_filter(labelled_reviews(spark, sf_dir), "fine_category")
            .select("id", "fine_category", "sentiment"))


@query("stage_shapes")
def q_stage_shapes(spark, sf_dir):
    return cleaning.stage_shapes(reviews(spark, sf_dir))


@query("preview_reviews")
def q_preview_reviews(spark, sf_dir):
    return cleaning.preview(clean_fixture_reviews(spark, sf_dir), "id", 5)


# ---------------------------------------------------------------- profiling
@query("count_by_sentiment")
def q_count_by_sentiment(spark, sf_dir):
    return profile.count_by_sentiment(clean_fixture_reviews(spark, sf_dir))


@query("count_by_sentiment_orders")
def q_count_by_sentiment_orders(spark, sf_dir):
    return profile.count_by_sentiment(clean_order_reviews(spark, sf_dir))


@query("sentiment_totals_orders")
def q_sentiment_totals_orders(spark, sf_dir):
    return profile.sentiment_totals(
        profile.count_by_category_sentiment(clean_order_reviews(spark, sf_dir)))


@query("crosscount_orders")
def q_crosscount_orders(spark, sf_dir):
    return profile.crosscount(clean_order_reviews(spark, sf_dir))


@query("split_sizes_orders")
def q_split_sizes_orders(spark, sf_dir):
    return profile.split_sizes(split_orders(spark, sf_dir))


@query("count_sentiment_by_category")
def q_count_sentiment_by_category(spark, sf_dir):
    return profile.count_sentiment_by_category(clean_fixture_reviews(spark, sf_dir))


@query("avg_sentiment_by_category")
def q_avg_sentiment_by_category(spark, sf_dir):
    return round_doubles(profile.avg_sentiment_by_category(clean_fixture_reviews(spark, sf_dir)))


@query("avg_sentiment_by_category_orders")
def q_avg_sentiment_by_category_orders(spark, sf_dir):
    return round_doubles(profile.avg_sentiment_by_category(clean_order_reviews(spark, sf_dir)))


@query("count_reviews_by_category")
def q_count_reviews_by_category(spark, sf_dir):
    return profile.count_reviews_by_category(clean_fixture_reviews(spark, sf_dir))


@query("max_category_count")
def q_max_category_count(spark, sf_dir):
    return profile.max_category_count(clean_fixture_reviews(spark, sf_dir))


@query("sentiment_totals")
def q_sentiment_totals(spark, sf_dir):
    return profile.sentiment_totals(
        profile.count_by_category_sentiment(clean_fixture_reviews(spark, sf_dir)))


@query("sentiment_pct_by_category")
def q_sentiment_pct_by_category(spark, sf_dir):
    return round_doubles(profile.sentiment_pct_by_category(clean_fixture_reviews(spark, sf_dir)))


@query("sentiment_pct_by_category_orders")
def q_sentiment_pct_by_category_orders(spark, sf_dir):
    return round_doubles(profile.sentiment_pct_by_category(clean_order_reviews(spark, sf_dir)))


@query("sentiment_pct_by_fine_category")
def q_sentiment_pct_by_fine_category(spark, sf_dir):
    """73 source/language categories, many lacking a sentiment (0.0 cells)."""
    return round_doubles(profile.sentiment_pct_by_category(labelled_reviews(spark, sf_dir),
                                                           cat="fine_category"))


@query("crosscount_unbalanced")
def q_crosscount_unbalanced(spark, sf_dir):
    return profile.crosscount(clean_fixture_reviews(spark, sf_dir))


@query("crosscount_fine_category")
def q_crosscount_fine_category(spark, sf_dir):
    """Zero-filled grid over the 73 source/language categories (many empty cells)."""
    return profile.crosscount(labelled_reviews(spark, sf_dir), cat="fine_category")


@query("min_cell_size")
def q_min_cell_size(spark, sf_dir):
    return profile.min_cell_size(clean_fixture_reviews(spark, sf_dir))


@query("min_cell_size_orders")
def q_min_cell_size_orders(spark, sf_dir):
    return profile.min_cell_size(clean_order_reviews(spark, sf_dir))


def review_texts(spark, sf_dir):
    """id and review_body alone: word counts need no labels."""
    return load_table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"),
                                                          F.col("text").alias("review_body"))


@query("review_word_counts")
def q_review_word_counts(spark, sf_dir):
    return profile.review_word_counts(review_texts(spark, sf_dir))


@query("word_count_describe")
def q_word_count_describe(spark, sf_dir):
    return round_doubles(profile.word_count_describe(review_texts(spark, sf_dir)))


@query("word_count_histogram")
def q_word_count_histogram(spark, sf_dir):
    return round_doubles(profile.word_count_histogram(review_texts(spark, sf_dir)))


# --------------------------------------------------------------------- bias
@query("bias_report")
def q_bias_report(spark, sf_dir):
    return round_doubles(bias.bias_report(labelled_reviews(spark, sf_dir), min_rows_exclusive=10))


@query("bias_report_orders")
def q_bias_report_orders(spark, sf_dir):
    return round_doubles(bias.bias_report(labelled_orders(spark, sf_dir), min_rows_exclusive=10))


def bias_from_config_file(spark, df, pretty=True):
    from revlens.session import scratch_path
    from revlens.sources.config import read_bias_config, write_bias_config
    path = write_bias_config(spark, scratch_path(spark, "bias-config"), pretty=pretty)
    return round_doubles(bias.bias_report_from_config(df, read_bias_config(spark, path)))


@query("bias_from_config")
def q_bias_from_config(spark, sf_dir):
    """Pretty-printed configuration, unbalanced data."""
    return bias_from_config_file(spark, clean_fixture_reviews(spark, sf_dir), pretty=True)


@query("bias_from_config_balanced")
def q_bias_from_config_balanced(spark, sf_dir):
    """Single-line configuration, balanced data."""
    return bias_from_config_file(
        spark, balanced(spark, sf_dir), pretty=False)


@query("bias_from_config_groups")
def q_bias_from_config_groups(spark, sf_dir):
    """Label and facet given as column numbers, the label's value as text, and
    two languages together as the facet's group."""
    from revlens.session import scratch_path
    from revlens.sources.config import DEFAULT_BIAS_CONFIG, read_bias_config, write_bias_config
    config = DEFAULT_BIAS_CONFIG | {
        "label": "0", "label_values_or_threshold": ["1"],
        "facet": [{"name_or_index": 2, "value_or_threshold": ["en", "de"]}]}
    path = write_bias_config(spark, scratch_path(spark, "bias-config"), config)
    return round_doubles(bias.bias_report_from_config(clean_fixture_reviews(spark, sf_dir), read_bias_config(spark, path)))


@query("bias_report_fine_category")
def q_bias_report_fine_category(spark, sf_dir):
    return round_doubles(bias.bias_report(labelled_reviews(spark, sf_dir), facet="fine_category"))


@query("word_count_quantiles")
def q_word_count_quantiles(spark, sf_dir):
    """Word-count quantiles per category from sketches kept per fine category."""
    return quantiles.read(quantiles.merge(_word_count_sketches(spark, sf_dir), ["product_category"]))


@query("word_count_quantile_errors")
def q_word_count_quantile_errors(spark, sf_dir):
    """Whether each of these quantiles keeps the stated rank error."""
    counted = _counted_reviews(spark, sf_dir)
    found = quantiles.read(quantiles.merge(_word_count_sketches(spark, sf_dir), ["product_category"]))
    return (quantiles.rank_errors(counted, found, "product_category", "num_words")
            .select("product_category", "level", (F.col("error") <= quantiles.rank_error()).alias("kept")))


# ----------------------------------------------------------------- sampling
@query("balanced_reviews")
def q_balanced_reviews(spark, sf_dir):
    return balanced(spark, sf_dir)


@query("balanced_orders")
def q_balanced_orders(spark, sf_dir):
    return balanced_order_reviews(spark, sf_dir)


@query("crosscount_balanced")
def q_crosscount_balanced(spark, sf_dir):
    return profile.crosscount(balanced(spark, sf_dir))


@query("bias_report_balanced")
def q_bias_report_balanced(spark, sf_dir):
    return round_doubles(bias.bias_report(
        balanced(spark, sf_dir)))


@query("bias_report_balanced_orders")
def q_bias_report_balanced_orders(spark, sf_dir):
    return round_doubles(bias.bias_report(
        balanced_order_reviews(spark, sf_dir)))


@query("training_projection")
def q_training_projection(spark, sf_dir):
    return (balanced(spark, sf_dir)
            .select("sentiment", "review_body"))


@query("stratified_split")
def q_stratified_split(spark, sf_dir):
    return split_reviews(spark, sf_dir).select("id", "sentiment", "split")


@query("stratified_split_orders")
def q_stratified_split_orders(spark, sf_dir):
    return split_orders(spark, sf_dir).select("id", "sentiment", "split")


@query("split_sizes")
def q_split_sizes(spark, sf_dir):
    return profile.split_sizes(split_reviews(spark, sf_dir))


# --------------------------------------------------------------------- text
@query("normalize_text")
def q_normalize_text(spark, sf_dir):
    return text_ops.normalize_reviews(texts_with_samples(spark, sf_dir)).withColumnRenamed(
        "review_body", "normalized")


@query("tokenize_reviews")
def q_tokenize_reviews(spark, sf_dir):
    return text_ops.tokenize_reviews(texts_with_samples(spark, sf_dir)).select("id", "tokens_text")


@query("abbreviation_scores")
def q_abbreviation_scores(spark, sf_dir):
    """How much every word with a final period looks like an abbreviation."""
    return round_doubles(abbr.abbreviation_scores(texts_with_samples(spark, sf_dir)))


@query("tokenize_abbreviations")
def q_tokenize_abbreviations(spark, sf_dir):
    """The tokens of every text, with the corpus' abbreviations kept whole."""
    texts = texts_with_samples(spark, sf_dir)
    found = abbr.abbreviations(abbr.abbreviation_scores(texts))
    kept = abbr.keep_abbreviation_periods(text_ops.with_tokens(texts), found)
    return kept.select("id", F.array_join("tokens", " ").alias("tokens_text"))


@query("label_prefix")
def q_label_prefix(spark, sf_dir):
    labels = clean_fixture_reviews(spark, sf_dir).select(
        "id", F.col("sentiment").cast("string").alias("label"))
    # Fixed edge values: an already prefixed label and a word starting with
    # prefix characters.
    edge = spark.createDataFrame([(-1, "__label__1"), (-2, "able"), (-3, "__label__able")],
                                 "id bigint, label string")
    return text_ops.label_prefix_table(labels.unionByName(edge))


@query("prepare_training_rows")
def q_prepare_training_rows(spark, sf_dir):
    clean = clean_fixture_reviews(spark, sf_dir).select("id", "sentiment", "review_body")
    samples = spark.createDataFrame(
        [(-(i + 1), s, t) for i, (s, t) in enumerate(text_ops.SAMPLE_PREPARATION_ROWS)],
        "id bigint, sentiment int, review_body string")
    return text_ops.prepare_training_rows(clean.unionByName(samples))


@query("labelled_text_lines")
def q_labelled_text_lines(spark, sf_dir):
    prepared = text_ops.prepare_training_rows(split_reviews(spark, sf_dir))
    return labelled_lines(prepared, prefixed=True, keep=("id", "split"))


@query("vocabulary_min_count")
def q_vocabulary_min_count(spark, sf_dir):
    return text_ops.vocabulary_min_count(text_ops.with_tokens(clean_fixture_reviews(spark, sf_dir)))


@query("word_ngrams")
def q_word_ngrams(spark, sf_dir):
    return text_ops.ngram_counts(text_ops.with_tokens(clean_fixture_reviews(spark, sf_dir)))


@query("frequent_ngrams")
def q_frequent_ngrams(spark, sf_dir):
    """The n-grams seen at least twice, counted level by level."""
    return frequent.frequent_ngrams(text_ops.with_tokens(clean_fixture_reviews(spark, sf_dir)))


@query("frequent_tokens")
def q_frequent_tokens(spark, sf_dir):
    """Tokens of every review, and those left of words seen at least twice."""
    ensure_checkpoint_dir(spark)
    held = (text_ops.with_tokens(clean_fixture_reviews(spark, sf_dir))
            .select("id", frequent.token_hashes("tokens").alias("hashes")).checkpoint(eager=True))
    kept = frequent.keep_frequent(held.withColumn("n_tokens", F.size("hashes").cast("bigint")),
                                  frequent.min_count_hashes(held, 2))
    return kept.select("id", "n_tokens", F.size("hashes").cast("bigint").alias("n_kept"))


# -------------------------------------------------------------- naive Bayes


def nb_fitted(spark, sf_dir):
    ensure_checkpoint_dir(spark)
    # Tokenised once: fitting and predicting read the written tokens.
    data = (text_ops.with_tokens(split_reviews(spark, sf_dir)).select("id", "sentiment", "split", "tokens")
            .checkpoint(eager=True))
    model = nb.fit_naive_bayes(data.where(F.col("split") == "train"))
    return model, data.where(F.col("split") == "validation")


def nb_validation_predictions(spark, sf_dir):
    model, validation = nb_fitted(spark, sf_dir)
    return nb.predict_naive_bayes(model, validation, keep=("sentiment",))


@query("nb_token_weights")
def q_nb_token_weights(spark, sf_dir):
    model, _ = nb_fitted(spark, sf_dir)
    return round_doubles(model.long_weights())


@query("nb_predictions")
def q_nb_predictions(spark, sf_dir):
    return nb_validation_predictions(spark, sf_dir).select("id", "sentiment", "prediction")


@query("nb_confusion_matrix")
def q_nb_confusion_matrix(spark, sf_dir):
    return nb.confusion_matrix(nb_validation_predictions(spark, sf_dir))


@query("nb_accuracy")
def q_nb_accuracy(spark, sf_dir):
    return round_doubles(nb.accuracy(nb_validation_predictions(spark, sf_dir)))


# ------------------------------------------------------- catalog / CSV / SQL


def registered_reviews(spark, sf_dir):
    return flows.register_reviews_table(spark, clean_fixture_reviews(spark, sf_dir), key=sf_dir)


@query("csv_roundtrip")
def q_csv_roundtrip(spark, sf_dir):
    return flows.csv_roundtrip(spark, clean_fixture_reviews(spark, sf_dir))


@query("catalog_count_by_sentiment")
def q_catalog_count_by_sentiment(spark, sf_dir):
    return sql_plans.run_statement(spark, "count_by_sentiment", registered_reviews(spark, sf_dir))


@query("catalog_avg_sentiment_by_category")
def q_catalog_avg_sentiment_by_category(spark, sf_dir):
    return round_doubles(sql_plans.run_statement(spark, "avg_sentiment_by_category",
                                                 registered_reviews(spark, sf_dir)))


@query("catalog_count_by_category_sentiment")
def q_catalog_count_by_category_sentiment(spark, sf_dir):
    return sql_plans.run_statement(spark, "count_by_category_sentiment",
                                   registered_reviews(spark, sf_dir))


@query("catalog_num_words")
def q_catalog_num_words(spark, sf_dir):
    return sql_plans.run_statement(spark, "num_words", registered_reviews(spark, sf_dir))


@query("sql_count_sentiment_by_category")
def q_sql_count_sentiment_by_category(spark, sf_dir):
    view = f"clean_reviews_{abs(hash(sf_dir)) % 10**8}"
    clean_fixture_reviews(spark, sf_dir).createOrReplaceTempView(view)
    return sql_plans.run_statement(spark, "count_sentiment_by_category", view)


# ------------------------------------------------------------- Spark ML


def _train_validation(spark, sf_dir):
    split = split_reviews(spark, sf_dir)
    return (split.where(F.col("split") == "train"), split.where(F.col("split") == "validation"))


# Fitted models are deterministic for a given input, so one fit per
# application and state of the two tables' files serves every query.
_FITTED: dict = {}


def _files(spark, sf_dir) -> int:
    """Changes with any file of the tables that models learn from."""
    stamp = 0
    for name in ("documents", "labels"):
        seen = load_table(spark, sf_dir, name).select("_metadata.file_path", "_metadata.file_size",
                                                      "_metadata.file_modification_time").distinct()
        own = F.xxhash64("file_path", "file_size", "file_modification_time", F.lit(name))
        stamp ^= seen.agg(F.bit_xor(own)).first()[0] or 0
    return stamp


def _memo(spark, sf_dir, name, build):
    key = (spark.sparkContext.applicationId, sf_dir, _files(spark, sf_dir), name)
    if key not in _FITTED:
        _FITTED[key] = build()
    return _FITTED[key]


def ngram_model(spark, sf_dir):
    def build():
        train, _ = _train_validation(spark, sf_dir)
        return cand.fit_on_features(cand.ngram_lr_pipeline(), train)
    return _memo(spark, sf_dir, "ngram_lr", build)


@query("train_text_classifier")
def q_train_text_classifier(spark, sf_dir):
    _, validation = _train_validation(spark, sf_dir)
    model = ngram_model(spark, sf_dir)
    return (cand.predict_sentiment(model, validation)
            .select("id", "sentiment", F.col("predicted_sentiment").alias("prediction")))


@query("training_metrics")
def q_training_metrics(spark, sf_dir):
    _, validation = _train_validation(spark, sf_dir)
    model = ngram_model(spark, sf_dir)
    acc = cand.accuracy(cand.predict_sentiment(model, validation)).first()["metric_value"]
    return cand.training_metrics(spark, model, acc)


def embedding_model(spark, sf_dir):
    def build():
        train, validation = (text_ops.with_tokens(d) for d in _train_validation(spark, sf_dir))
        return embedding.fit_embedding_classifier(train, validation)
    return _memo(spark, sf_dir, "embedding", build)


@query("train_embedding_classifier")
def q_train_embedding_classifier(spark, sf_dir):
    """Validation reviews labelled by the embedding classifier with its
    published settings."""
    _, validation = _train_validation(spark, sf_dir)
    return (embedding_model(spark, sf_dir).predict(text_ops.with_tokens(validation), keep=("sentiment",))
            .select("id", "sentiment", "prediction"))


#: Settings that the halving starts from.
HALVING_GRID = {f"words_{n}_reg_{reg}": {"max_n": n, "reg_param": reg}
                for n in (1, 3) for reg in (0.001, 0.01)}


@query("halving_table")
def q_halving_table(spark, sf_dir):
    """Rung, setting, rows, validation accuracy and whether it went on: n-gram
    settings on nested samples, the last on all training rows."""
    train, validation = _train_validation(spark, sf_dir)
    found = _memo(spark, sf_dir, "halving", lambda: halving.halve_ngram_lr(train, validation, HALVING_GRID))
    return found.table(spark)


@query("embedding_training_metrics")
def q_embedding_training_metrics(spark, sf_dir):
    """Loss on the training and accuracy on the validation part per epoch."""
    return spark.createDataFrame(embedding_model(spark, sf_dir).metrics,
                                 "epoch int, metric_name string, value double")


def _leaderboard(spark, sf_dir):
    def build():
        train, validation = _train_validation(spark, sf_dir)
        return cand.fit_candidates(train, validation,
                                   prefit={"ngram_lr": ngram_model(spark, sf_dir)})
    results = _memo(spark, sf_dir, "candidates", build)
    return cand.leaderboard(spark, results), results


@query("candidate_leaderboard")
def q_candidate_leaderboard(spark, sf_dir):
    return _leaderboard(spark, sf_dir)[0].drop("as_json")


@query("best_candidate")
def q_best_candidate(spark, sf_dir):
    return _leaderboard(spark, sf_dir)[0].where(F.col("rank") == 1)


@query("score_reviews")
def q_score_reviews(spark, sf_dir):
    """Every review text plus the sample reviews, scored by the best
    candidate of the leaderboard."""
    _, results = _leaderboard(spark, sf_dir)
    best = cand.best_result(results)
    samples = spark.createDataFrame(
        [(-(i + 1), t) for i, t in enumerate(text_ops.SAMPLE_SCORING_REVIEWS)],
        "id bigint, review_body string")
    to_score = review_texts(spark, sf_dir).unionByName(samples)
    return cand.score_with_candidate(best, to_score).withColumn("candidate_name", F.lit(best.name))


@query("stream_score_reviews")
def q_stream_score_reviews(spark, sf_dir):
    """Every document scored through a file stream (availableNow) into a
    parquet sink in the shared folder; returns the sink's rows."""
    import os

    from revlens.session import scratch_path
    from revlens.streaming.scoring import review_stream, start_scoring
    model = ngram_model(spark, sf_dir)
    schema = spark.read.parquet(os.path.join(sf_dir, "documents.parquet")).schema
    # A file stream watches a folder or glob; this glob matches one table.
    stream = (review_stream(spark, os.path.join(sf_dir, "documents*.parquet"), schema)
              .withColumnRenamed("doc_id", "id"))
    sink, ckpt = scratch_path(spark, "scored-sink"), scratch_path(spark, "scored-ckpt")
    q = start_scoring(model, stream, sink, ckpt, text_col="text")
    q.awaitTermination()
    return spark.read.parquet(sink)


@query("stream_scored_once")
def q_stream_scored_once(spark, sf_dir):
    """Every document through the restartable sink, started twice on the same
    checkpoint, the second time with every document delivered again: how often
    each id was scored."""
    import os

    from revlens.session import scratch_path
    from revlens.streaming.scoring import read_scored, start_scoring_once
    model = ngram_model(spark, sf_dir)
    arriving = scratch_path(spark, "arriving")
    documents = load_table(spark, sf_dir, "documents")
    sink, ckpt = scratch_path(spark, "scored-once"), scratch_path(spark, "scored-once-ckpt")
    for delivery in ("first", "again"):
        documents.write.parquet(os.path.join(arriving, f"delivery={delivery}"))
        stream = (spark.readStream.schema(documents.schema).parquet(os.path.join(arriving, "delivery=*"))
                  .withColumn("arrived", F.col("_metadata.file_modification_time")).withColumnRenamed("doc_id", "id"))
        start_scoring_once(model, stream, sink, ckpt, text_col="text").awaitTermination()
    return read_scored(spark, sink).groupBy("id").agg(F.count(F.lit(1)).alias("times"))
