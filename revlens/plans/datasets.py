"""Cleaned datasets derived from the stand-in tables (see FIXTURES.md).

Both are lazy frames: a query that counts categories scans the columns it
needs and writes nothing.  Only the jobs (``plans/jobs.py``) and the flows
write tables, where writing is the feature.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from revlens.operators.cleaning import (
    clean_reviews, drop_incomplete, frequent_categories, label_sentiment, rare_category_filter,
)
from revlens.operators.sampling import narrow_rows
from revlens.sources.tables import order_reviews, reviews


def clean_fixture_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, sentiment, review_body, product_category (language) of every
    labelled document, rare categories (<= 10 rows) removed."""
    return clean_reviews(reviews(spark, sf_dir), keep_columns=["id"])


def clean_order_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, sentiment, product_category (market segment) of every order."""
    df = drop_incomplete(order_reviews(spark, sf_dir), ("star_rating", "product_category"))
    return rare_category_filter(label_sentiment(df)).select("id", "sentiment", "product_category")


def _with_narrow(labelled: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of frequent categories, and their (id, sentiment, category, hash)
    written once; the categories are counted on the narrow rows."""
    narrow = narrow_rows(labelled, ["sentiment", "product_category"])
    kept = frequent_categories(narrow)
    return tuple(df.join(kept, "product_category", "left_semi") for df in (labelled, narrow))


def fixture_reviews_with_narrow(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """``clean_fixture_reviews`` for operators that decide on narrow rows: the
    texts are read once for those and once for the answer."""
    labelled = label_sentiment(drop_incomplete(reviews(spark, sf_dir)))
    return _with_narrow(labelled.select("id", "sentiment", "review_body", "product_category"))


def order_reviews_with_narrow(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """``clean_order_reviews`` and its narrow rows."""
    df = drop_incomplete(order_reviews(spark, sf_dir), ("star_rating", "product_category"))
    return _with_narrow(label_sentiment(df).select("id", "sentiment", "product_category"))
