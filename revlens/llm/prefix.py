"""Running sums over keys of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def running_sums(df: DataFrame, value: str, keys: list[str], bucket: str, order: list[str], out: str) -> DataFrame:
    """Adds ``out``: the sum of ``value`` over all earlier rows of the same keys.

    Rows are ordered by ``bucket`` and then by ``order``.  No task holds a
    whole key: the sums of its buckets are accumulated first (one row per key
    and bucket), then each bucket's rows start from its bucket's sum.
    ``bucket`` isn't null; ``value`` null counts as 0.
    """
    whole = df.groupBy(*keys, bucket).agg(F.sum(value).alias("__all"))
    earlier = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = whole.select(*keys, bucket, F.coalesce(F.sum("__all").over(earlier), F.lit(0)).alias("__start"))
    inside = Window.partitionBy(*keys, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (df.withColumn("__inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
            .join(starts, [*keys, bucket])
            .withColumn(out, F.col("__start") + F.col("__inside"))
            .drop("__start", "__inside"))


def ranked(df: DataFrame, order: list, out: str, cut) -> DataFrame:
    """Adds ``out``, 0 for the first row of the whole table in ``order``.

    The table is sorted by ranges and written once, so that its partitions
    stay what they are; a row's rank is its partition's start and its place
    there.
    """
    held = cut(df.orderBy(*order)).withColumn("__part", F.spark_partition_id()).withColumn("__one", F.lit(1))
    return running_sums(held, "__one", [], "__part", order, out).drop("__part", "__one")
