"""The profiling statements as Spark SQL over a named table or view.

The table name is bound with ``IDENTIFIER(:table)`` (no string splicing);
orderings state their null placement.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The profiling statements; their column aliases are part of
# the output contract of the workflow.
STATEMENTS = {
    "count_by_sentiment": """
        SELECT sentiment, COUNT(sentiment) AS count_sentiment
        FROM IDENTIFIER(:table)
        GROUP BY sentiment
        ORDER BY sentiment ASC NULLS LAST""",
    "count_sentiment_by_category": """
        SELECT product_category, COUNT(sentiment) AS count_sentiment
        FROM IDENTIFIER(:table)
        GROUP BY product_category
        ORDER BY count_sentiment DESC NULLS LAST, product_category""",
    "avg_sentiment_by_category": """
        SELECT product_category, AVG(sentiment) AS avg_sentiment
        FROM IDENTIFIER(:table)
        GROUP BY product_category
        ORDER BY avg_sentiment DESC NULLS LAST, product_category""",
    "count_reviews_by_category": """
        SELECT product_category, COUNT(*) AS count_reviews
        FROM IDENTIFIER(:table)
        GROUP BY product_category
        ORDER BY count_reviews DESC NULLS LAST, product_category""",
    "count_by_category_sentiment": """
        SELECT product_category, sentiment, COUNT(*) AS count_reviews
        FROM IDENTIFIER(:table)
        GROUP BY product_category, sentiment
        ORDER BY product_category ASC NULLS LAST, sentiment DESC NULLS LAST, count_reviews""",
    "num_words": """
        SELECT CAST(CARDINALITY(SPLIT(review_body, ' ', -1)) AS BIGINT) AS num_words
        FROM IDENTIFIER(:table)""",
}


def run_statement(spark: SparkSession, name: str, table: str) -> DataFrame:
    return spark.sql(STATEMENTS[name], args={"table": table})
