"""Text operators: normalisation, tokenisation, labelled training rows,
corpus vocabulary and word n-grams.

Token and n-gram statistics are ``explode`` + ``groupBy`` plans: partial
aggregation combines a hot token (``the``) inside each map task, so only
one row per (token, task) is shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from revlens.functions.text import (
    add_label_prefix, explode_tokens, normalize_for_training, strip_label_prefix,
    tokenize_text, tokens_of, word_ngrams,
)

# The sample sentences used to illustrate tokenisation and
# scoring, with the labels of the three preparation examples.
SAMPLE_SENTENCE = "I'm not a fan of this product!"
SAMPLE_PREPARATION_ROWS = [
    (-1, "I don't like this product!"),
    (0, "this product is ok"),
    (1, "I do like this product!"),
]
SAMPLE_SCORING_REVIEWS = [
    "This product is great!",
    "OK, but not great.",
    "This is not the right product.",
]


def normalize_reviews(df: DataFrame, text_col: str = "review_body") -> DataFrame:
    return df.withColumn(text_col, normalize_for_training(text_col))


def tokenize_reviews(df: DataFrame, text_col: str = "review_body",
                     out_col: str = "tokens_text") -> DataFrame:
    """Adds the tokenised text (space-joined) as ``out_col``."""
    return df.withColumn(out_col, tokenize_text(text_col))


def prepare_training_rows(df: DataFrame, label_col: str = "sentiment",
                          text_col: str = "review_body") -> DataFrame:
    """``__label__<y>`` label and tokenised, lower-cased body, as one select."""
    return df.withColumns({label_col: add_label_prefix(label_col),
                           text_col: tokenize_text(text_col)})


def label_prefix_table(df: DataFrame, label_col: str = "label") -> DataFrame:
    """The label with the prefix added (idempotent) and removed again."""
    return df.select("*", add_label_prefix(label_col).alias("prefixed"),
                     strip_label_prefix(add_label_prefix(label_col)).alias("stripped"))


def with_tokens(df: DataFrame, text_col: str = "review_body", tokens_col: str = "tokens") -> DataFrame:
    """Array of tokens of the (normalised) review text."""
    return df.withColumn(tokens_col, tokens_of(tokenize_text(text_col)))


def token_counts(df: DataFrame, tokens_col: str = "tokens") -> DataFrame:
    """Corpus frequency of every token."""
    return (df.select(explode_tokens(tokens_col).alias("token"))
            .where(F.col("token").isNotNull())
            .groupBy("token").agg(F.count(F.lit(1)).alias("token_count")))


def vocabulary_min_count(df: DataFrame, tokens_col: str = "tokens", min_count: int = 2) -> DataFrame:
    """Tokens seen at least ``min_count`` times in the corpus (not document
    frequency: one review repeating a word twice keeps it)."""
    return token_counts(df, tokens_col).where(F.col("token_count") >= min_count)


def _tagged_ngrams(tokens_col: str, n: int):
    return F.transform(word_ngrams(tokens_col, n),
                       lambda g: F.struct(F.lit(n).alias("n"), g.alias("ngram")))


def ngram_counts(df: DataFrame, tokens_col: str = "tokens", max_n: int = 3,
                 min_count: int = 1) -> DataFrame:
    """Corpus frequency of all word n-grams, n = 1..max_n (of those seen at
    least ``min_count`` times, where a caller asks for that)."""
    grams = F.concat(*[_tagged_ngrams(tokens_col, n) for n in range(1, max_n + 1)])
    per_n = (df.select(explode_tokens(grams).alias("x"))
             .where(F.col("x").isNotNull())
             .select("x.n", "x.ngram"))
    counts = per_n.groupBy("n", "ngram").agg(F.count(F.lit(1)).alias("ngram_count"))
    return counts if min_count <= 1 else counts.where(F.col("ngram_count") >= min_count)


def add_ngrams(df: DataFrame, tokens_col: str = "tokens", max_n: int = 3,
               out_col: str = "ngrams") -> DataFrame:
    """Array of all 1..max_n word n-grams of each review."""
    parts = [word_ngrams(tokens_col, n) for n in range(1, max_n + 1)]
    return df.withColumn(out_col, F.concat(*parts))
