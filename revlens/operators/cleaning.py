"""Cleaning operators: raw reviews -> (sentiment, review_body, product_category).

Each function is ``DataFrame -> DataFrame`` and lazy (usable with
``df.transform``), except ``rare_category_filter`` which runs one small
aggregate first to prove the kept-category list may be broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from revlens.functions.sentiment import rating_to_sentiment
from revlens.operators.joins import LOCAL_COPY_ROWS, small_local_copy

# Raw header names and their new names.
RAW_RENAMES = {"Review Text": "review_body", "Rating": "star_rating",
               "Class Name": "product_category"}
RAW_DROPPED = ["Clothing ID", "Age", "Title", "Recommended IND",
               "Positive Feedback Count", "Division Name", "Department Name"]
CLEAN_COLUMNS = ["sentiment", "review_body", "product_category"]


def rename_raw_columns(df: DataFrame) -> DataFrame:
    """Rename the three kept columns (missing names are ignored) and drop the
    seven unused ones; a missing dropped column is an error, as in pandas."""
    missing = [c for c in RAW_DROPPED if c not in df.columns]
    if missing:
        raise ValueError(f"columns not found: {missing}")
    return df.withColumnsRenamed(RAW_RENAMES).drop(*RAW_DROPPED)


def drop_incomplete(df: DataFrame, subset=("star_rating", "review_body", "product_category")) -> DataFrame:
    return df.dropna(how="any", subset=list(subset))


def label_sentiment(df: DataFrame, rating_col: str = "star_rating") -> DataFrame:
    """Add ``sentiment`` from the star rating and drop the rating column.

    A string rating (raw CSV) is cast by ``try_cast`` first; unmapped
    ratings give a null sentiment and the row is kept.
    """
    rating = F.col(rating_col)
    if dict(df.dtypes)[rating_col] == "string":
        rating = rating.try_cast("double")
    return df.withColumn("sentiment", rating_to_sentiment(rating)).drop(rating_col)


def category_sizes(df: DataFrame, category_col: str = "product_category") -> DataFrame:
    return df.groupBy(category_col).agg(F.count(F.lit(1)).alias("category_rows"))


def rare_category_filter(df: DataFrame, category_col: str = "product_category",
                         min_rows_exclusive: int = 10,
                         max_broadcast_rows: int = LOCAL_COPY_ROWS) -> DataFrame:
    """Keep rows whose category has strictly more than ``min_rows_exclusive``
    rows; null categories are dropped.

    Only (category, count) pairs are shuffled (partial aggregation), never
    the review bodies.  The kept categories are materialised once (one pass
    over the data) and semi-joined back: broadcast when their number is
    proved small, otherwise checkpointed and joined by shuffle.
    """
    kept = frequent_categories(df, category_col, min_rows_exclusive, max_broadcast_rows)
    return df.join(kept, category_col, "left_semi")


def frequent_categories(df: DataFrame, category_col: str = "product_category", min_rows_exclusive: int = 10,
                        max_broadcast_rows: int = LOCAL_COPY_ROWS) -> DataFrame:
    """The categories that ``rare_category_filter`` keeps, ready to be joined:
    counted in one pass, marked for broadcast when proved small."""
    kept = (category_sizes(df.where(F.col(category_col).isNotNull()), category_col)
            .where(F.col("category_rows") > min_rows_exclusive)
            .select(category_col))
    kept, small = small_local_copy(kept, max_broadcast_rows)
    return kept if small is None else F.broadcast(kept)


def clean_reviews(df: DataFrame, category_col: str = "product_category",
                  rare_filter_col: str | None = None, min_rows_exclusive: int = 10,
                  keep_columns: list | None = None) -> DataFrame:
    """Drop incomplete rows, derive sentiment, drop rare categories.

    ``rare_filter_col`` defaults to ``category_col``; ``keep_columns`` are
    extra columns carried along (e.g. an ``id``).
    """
    extra = [c for c in (keep_columns or []) if c in df.columns]
    out = label_sentiment(drop_incomplete(df, ("star_rating", "review_body", category_col)))
    out = rare_category_filter(out, rare_filter_col or category_col, min_rows_exclusive)
    cols = ["sentiment", "review_body", category_col]
    if category_col != "product_category":
        out = out.withColumnRenamed(category_col, "product_category")
        cols[-1] = "product_category"
    return out.select(*extra, *cols)


def clean_raw_reviews(raw: DataFrame) -> DataFrame:
    """The whole raw -> clean chain of the reference on a raw review file."""
    df = rename_raw_columns(raw)
    df = drop_incomplete(df)
    df = label_sentiment(df)
    df = rare_category_filter(df)
    return df.select(*CLEAN_COLUMNS)


def preview(df: DataFrame, order_col: str = "id", n: int = 5) -> DataFrame:
    """First ``n`` rows in a deterministic order (top-k, no full sort)."""
    return df.orderBy(F.col(order_col).asc_nulls_last()).limit(n)


def stage_shapes(raw: DataFrame, category_col: str = "product_category",
                 rare_filter_col: str | None = None, min_rows_exclusive: int = 10,
                 required=("star_rating", "review_body")) -> DataFrame:
    """(stage, rows, cols) for raw, after dropna, after the rare filter.

    One narrow pass for the category sizes and one for the three counts.
    """
    rare_col = rare_filter_col or category_col
    needed = list(dict.fromkeys([*required, category_col]))
    complete = F.lit(True)
    for c in needed:
        complete = complete & F.col(c).isNotNull()
    flagged = raw.select(rare_col, complete.alias("_complete"))
    kept = (category_sizes(flagged.where("_complete").where(F.col(rare_col).isNotNull()), rare_col)
            .where(F.col("category_rows") > min_rows_exclusive)
            .select(rare_col, F.lit(True).alias("_kept")))
    kept, small = small_local_copy(kept)
    if small is not None:
        kept = F.broadcast(kept)
    counts = (flagged.join(kept, rare_col, "left")
              .agg(F.count(F.lit(1)).alias("raw_rows"),
                   F.count(F.when(F.col("_complete"), 1)).alias("dropna_rows"),
                   F.count(F.when(F.col("_complete") & F.col("_kept"), 1)).alias("final_rows")))
    n_raw, n_dropna, n_final = len(raw.columns), len(needed), 3
    return counts.select(F.expr(
        f"stack(3, 'raw', raw_rows, {n_raw}, 'dropna', dropna_rows, {n_dropna}, "
        f"'final', final_rows, {n_final}) AS (stage, n_rows, n_cols)"))
