"""Profiling aggregates over cleaned reviews (counts, averages, shares,
word-count statistics and histogram).

All are single lazy plans: partial (map-side) aggregation followed by one
small shuffle of group keys, so a hot category costs nothing extra.
Orderings state their null placement explicitly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from revlens.functions.text import word_count
from revlens.operators.joins import small_local_copy

# Percentiles reported by the word-count description and the
# histogram layout (100 bins over [0, 256], last bin closed).
DESCRIBE_PERCENTILES = [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]
HIST_BINS = 100
HIST_LOW, HIST_HIGH = 0, 256


def count_by_sentiment(df: DataFrame, label: str = "sentiment") -> DataFrame:
    """COUNT(sentiment) per sentiment (the null group reports 0)."""
    return (df.groupBy(label).agg(F.count(label).alias("count_sentiment"))
            .orderBy(F.col(label).asc_nulls_last()))


def count_sentiment_by_category(df: DataFrame, cat: str = "product_category",
                                label: str = "sentiment") -> DataFrame:
    return (df.groupBy(cat).agg(F.count(label).alias("count_sentiment"))
            .orderBy(F.col("count_sentiment").desc_nulls_last(), F.col(cat).asc_nulls_last()))


def avg_sentiment_by_category(df: DataFrame, cat: str = "product_category",
                              label: str = "sentiment", display: bool = False) -> DataFrame:
    out = df.groupBy(cat).agg(F.avg(label).alias("avg_sentiment"))
    if display:  # half-even, like Python's round()
        out = out.withColumn("avg_sentiment_display", F.bround("avg_sentiment", 2))
    return out.orderBy(F.col("avg_sentiment").desc_nulls_last(), F.col(cat).asc_nulls_last())


def count_reviews_by_category(df: DataFrame, cat: str = "product_category") -> DataFrame:
    return (df.groupBy(cat).agg(F.count(F.lit(1)).alias("count_reviews"))
            .orderBy(F.col("count_reviews").desc_nulls_last(), F.col(cat).asc_nulls_last()))


def max_category_count(df: DataFrame, cat: str = "product_category") -> DataFrame:
    """Largest number of reviews of one category."""
    return (df.groupBy(cat).agg(F.count(F.lit(1)).alias("count_reviews"))
            .agg(F.max("count_reviews").alias("max_count_reviews")))


def count_by_category_sentiment(df: DataFrame, cat: str = "product_category",
                                label: str = "sentiment") -> DataFrame:
    return (df.groupBy(cat, label).agg(F.count(F.lit(1)).alias("count_reviews"))
            .orderBy(F.col(cat).asc_nulls_last(), F.col(label).desc_nulls_last(),
                     F.col("count_reviews").asc()))


def sentiment_totals(breakdown: DataFrame, label: str = "sentiment") -> DataFrame:
    """Re-aggregate a (category, sentiment, count_reviews) breakdown per
    sentiment plus a grand-total row (``is_total``), kept apart from a null
    sentiment by ``grouping_id``."""
    return (breakdown.rollup(label)
            .agg(F.sum("count_reviews").cast("bigint").alias("count_reviews"),
                 (F.grouping_id() == 1).alias("is_total"))
            .orderBy(F.col("is_total").asc(), F.col(label).asc_nulls_last()))


def sentiment_pct_by_category(df: DataFrame, cat: str = "product_category",
                              label: str = "sentiment", values=(1, 0, -1),
                              names=("pct_positive", "pct_neutral", "pct_negative")) -> DataFrame:
    """Share (x100) of each sentiment within its category, one row per
    category.  A missing cell is 0.0; null sentiments are not counted."""
    counts = (df.where(F.col(label).isNotNull())
              .groupBy(cat).pivot(label, list(values)).agg(F.count(F.lit(1))))
    cells = [F.coalesce(F.col(f"`{v}`"), F.lit(0)) for v in values]
    total = cells[0]
    for c in cells[1:]:
        total = total + c
    return counts.select(
        cat, *[(F.try_divide(c, total) * F.lit(100.0)).alias(n) for c, n in zip(cells, names)])


def crosscount(df: DataFrame, cat: str = "product_category", label: str = "sentiment",
               zero_fill: bool = True, max_labels: int = 10_000) -> DataFrame:
    """Rows per (sentiment, category): the data behind a grouped count plot.

    ``zero_fill`` reports 0 for an observed sentiment missing in a category
    (the observed grid): each category explodes the observed labels.  Null keys form their own rows, as in the plain count.
    """
    if not zero_fill:
        return (df.groupBy(label, cat).agg(F.count(F.lit(1)).alias("count_reviews"))
                .orderBy(F.col(label).asc_nulls_last(), F.col(cat).asc_nulls_last()))
    # The counted cells are the only pass over the data; labels come from them.
    cells, _ = small_local_copy(df.groupBy(label, cat).agg(F.count(F.lit(1)).alias("count_reviews")))
    labels = [r[0] for r in cells.select(label).distinct().limit(max_labels + 1).collect()]
    if len(labels) > max_labels:
        raise ValueError(f"{label} has more than {max_labels} values")
    observed = sorted(v for v in labels if v is not None)
    # Each category asks for every observed label; absent cells count 0.
    grid = (cells.where(F.col(label).isNotNull()).select(cat).distinct()
            .withColumn(label, F.explode(F.array(*map(F.lit, observed)).cast(f"array<{dict(df.dtypes)[label]}>"))))
    kept = cells.select(F.col(label).alias("_l"), F.col(cat).alias("_c"), "count_reviews")
    filled = (grid.join(kept, F.col("_l").eqNullSafe(F.col(label)) & F.col("_c").eqNullSafe(F.col(cat)), "left")
              .select(label, cat, F.coalesce("count_reviews", F.lit(0)).alias("count_reviews")))
    out = filled.unionByName(cells.where(F.col(label).isNull()).select(label, cat, "count_reviews"))
    return (out.select(label, cat, F.col("count_reviews").cast("bigint").alias("count_reviews"))
            .orderBy(F.col(label).asc_nulls_last(), F.col(cat).asc_nulls_last()))


def min_cell_size(df: DataFrame, cat: str = "product_category", label: str = "sentiment") -> DataFrame:
    """Smallest observed (category, sentiment) cell (null keys excluded)."""
    return (df.where(F.col(cat).isNotNull() & F.col(label).isNotNull())
            .groupBy(cat, label).agg(F.count(F.lit(1)).alias("n"))
            .agg(F.min("n").alias("min_cell_size"), F.count(F.lit(1)).alias("n_cells")))


def review_word_counts(df: DataFrame, body: str = "review_body", id_col: str | None = "id") -> DataFrame:
    cols = [id_col] if id_col else []
    return df.select(*cols, word_count(body).alias("num_words"))


def describe(df: DataFrame, col: str = "num_words", exact: bool = True,
             accuracy: int = 10_000) -> DataFrame:
    """count, mean, sample std, min, 10..100 % percentiles, max.

    ``exact`` percentiles interpolate linearly like pandas and keep one
    counter per distinct value -- small for word counts.  ``exact=False``
    uses ``percentile_approx`` (a bounded sketch, nearest-rank values) for
    unbounded doubles."""
    levels = F.array(*[F.lit(p) for p in DESCRIBE_PERCENTILES])
    pct = (F.percentile(F.col(col), levels) if exact
           else F.percentile_approx(F.col(col), levels, accuracy).cast("array<double>"))
    stats = df.agg(F.count(col).alias("count"), F.avg(col).alias("mean"),
                   F.stddev_samp(col).alias("std"), F.min(col).cast("double").alias("min"),
                   pct.alias("_p"), F.max(col).cast("double").alias("max"))
    return stats.select("count", "mean", "std", "min",
                        *[F.col("_p")[i].alias(f"p{int(round(p * 100))}")
                          for i, p in enumerate(DESCRIBE_PERCENTILES)],
                        "max")


def word_count_describe(df: DataFrame, body: str = "review_body") -> DataFrame:
    return describe(review_word_counts(df, body, None), "num_words")


def histogram(df: DataFrame, col: str = "num_words", bins: int = HIST_BINS,
              low: float = HIST_LOW, high: float = HIST_HIGH) -> DataFrame:
    """Fixed-width histogram over [low, high]: values outside are dropped, the
    last bin is closed on the right, empty bins report 0."""
    spark: SparkSession = df.sparkSession
    x = F.col(col)
    width = F.lit(float(high - low))
    idx = F.least(F.floor((x - F.lit(low)) * F.lit(bins) / width), F.lit(bins - 1)).cast("int")
    counts = (df.where(x.between(low, high)).groupBy(idx.alias("bin"))
              .agg(F.count(F.lit(1)).alias("frequency")))
    grid = spark.range(bins).select(
        F.col("id").cast("int").alias("bin"),
        (F.lit(float(low)) + F.col("id") * width / F.lit(bins)).alias("bin_start"),
        (F.lit(float(low)) + (F.col("id") + 1) * width / F.lit(bins)).alias("bin_end"))
    # ``grid`` has exactly ``bins`` rows and ``counts`` at most as many.
    return (grid.join(F.broadcast(counts), "bin", "left")
            .select("bin", "bin_start", "bin_end",
                    F.coalesce(F.col("frequency"), F.lit(0)).cast("bigint").alias("frequency"))
            .orderBy("bin"))


def word_count_histogram(df: DataFrame, body: str = "review_body") -> DataFrame:
    return histogram(review_word_counts(df, body, None), "num_words")


def split_sizes(split_df: DataFrame, split_col: str = "split") -> DataFrame:
    """Rows per split part and its share (one decimal, as a pie label)."""
    counts = split_df.groupBy(split_col).agg(F.count(F.lit(1)).alias("n_rows"))
    # At most a handful of split names: a window over them is one tiny task.
    from pyspark.sql import Window
    total = F.sum("n_rows").over(Window.partitionBy(F.lit(1)))
    return (counts.select(split_col, "n_rows",
                          F.round(F.try_divide(F.col("n_rows") * 100.0, total), 1).alias("pct"))
            .orderBy(split_col))
