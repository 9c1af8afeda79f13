"""Stand-in review tables built from the generated parquet test data.

``reviews``        documents LEFT JOIN labels (text, 4 language categories,
                   73 source/language fine categories, star rating derived
                   from the quality/toxic labels; unlabelled rows have none)
``order_reviews``  orders JOIN customer (no text; market segment as category,
                   order priority digit as star rating)

Both are plain lazy plans over the parquet scans, so Catalyst prunes the
columns a query does not use (the review text is not read for counts) and
chooses the join strategy from the table sizes (AQE re-checks at run time).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def star_rating_from_labels(quality: F.Column, toxic: F.Column) -> F.Column:
    # Fixed values: (quality, toxic) -> star rating of the stand-in table.
    return (F.when((quality == 1) & (toxic == 0), F.lit(5))
            .when((quality == 1) & (toxic == 1), F.lit(3))
            .when((quality == 0) & (toxic == 0), F.lit(2))
            .when((quality == 0) & (toxic == 1), F.lit(1)))


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, review_body, product_category, fine_category, star_rating."""
    docs = load_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    labels = load_table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    return (docs.join(labels, "doc_id", "left")
            .select(F.col("doc_id").alias("id"),
                    F.col("text").alias("review_body"),
                    F.col("lang").alias("product_category"),
                    F.concat(F.col("source"), F.lit("/"), F.col("lang")).alias("fine_category"),
                    star_rating_from_labels(F.col("quality"), F.col("toxic")).alias("star_rating")))


def order_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, product_category, star_rating (no review text)."""
    orders = load_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    customer = load_table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return (orders.join(customer, orders.o_custkey == customer.c_custkey, "inner")
            .select(F.col("o_orderkey").alias("id"),
                    F.col("c_mktsegment").alias("product_category"),
                    F.substring("o_orderpriority", 1, 1).cast("int").alias("star_rating")))
