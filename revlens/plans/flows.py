"""End-to-end flows: clean -> write -> register -> query, and the CSV round
trip.  Written tables go to the session's shared checkpoint folder."""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession

from revlens.session import scratch_path
from revlens.sources import catalog
from revlens.sources.csv_io import read_clean_reviews, write_clean_csv

_REGISTERED: dict = {}


def csv_roundtrip(spark: SparkSession, df: DataFrame, name: str = "clean_reviews") -> DataFrame:
    """Write ``df`` as headed CSV and read it back (types restored by name)."""
    path = scratch_path(spark, f"{name}-csv")
    write_clean_csv(df, path)
    return read_clean_reviews(spark, path)


def register_reviews_table(spark: SparkSession, clean: DataFrame, key: str,
                           database: str = "review_analytics", table: str = "reviews") -> str:
    """Write the three review columns as CSV, create the database and the
    CSV-backed table once per (session, key), return the qualified name.
    The key (the data folder) is part of the table's name."""
    table = f"{table}_{zlib.crc32(key.encode()):08x}"  # one table per data folder
    cache_key = (spark.sparkContext.applicationId, database, table)
    if cache_key in _REGISTERED:
        return _REGISTERED[cache_key]
    path = scratch_path(spark, "reviews-table")
    write_clean_csv(clean.select("sentiment", "review_body", "product_category"), path)
    catalog.create_database(spark, database, scratch_path(spark, f"{database}-db"))
    full = catalog.register_csv_table(spark, database, table, path)
    _REGISTERED[cache_key] = full
    return full


def write_raw_reviews_csv(spark: SparkSession, df: DataFrame, path: str) -> str:
    """Write review rows in the raw file layout: a leading unnamed index
    column, then the ten named raw columns (unused ones left empty)."""
    from pyspark.sql import functions as F
    raw = df.select(
        F.col("id").cast("string").alias("_index"),
        F.col("id").cast("string").alias("Clothing ID"),
        F.lit(None).cast("string").alias("Age"),
        F.lit(None).cast("string").alias("Title"),
        F.col("review_body").alias("Review Text"),
        F.col("star_rating").cast("string").alias("Rating"),
        F.lit(None).cast("string").alias("Recommended IND"),
        F.lit(None).cast("string").alias("Positive Feedback Count"),
        F.lit(None).cast("string").alias("Division Name"),
        F.lit(None).cast("string").alias("Department Name"),
        F.col("product_category").alias("Class Name"))
    # The index column has a blank header, as good as unnamed.
    write_clean_csv(raw.withColumnRenamed("_index", " "), path)
    return path
