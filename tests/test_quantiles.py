"""Quantile sketches: rank error on skewed doubles, merging, defined cases."""

import pytest
from pyspark.sql import functions as F

from revlens.operators import quantiles as q


@pytest.fixture(scope="module")
def skewed(spark):
    """A hot group with a third of the rows and more; heavy tails, ties, exact integers."""
    i = F.col("id")
    u = (F.abs(F.xxhash64(i)) % 1_000_003 + 1) / 1_000_004.0
    return spark.range(0, 120_000, numPartitions=7).select(
        F.when(i % 5 < 3, "hot").when(i % 5 == 3, "ties").otherwise("tail").alias("g"), (i % 4).alias("day"),
        F.when(i % 5 == 3, i % 3).when(i % 5 == 4, F.exp(-12 * F.log(u))).otherwise(F.exp(-F.log(u))).cast("double").alias("x"))


def test_rank_error_of_merged_sketches_on_skewed_doubles(skewed):
    fine = q.sketch(skewed, ["g", "day"], "x")
    once = q.read(q.merge(fine, ["g"]))
    rows = q.rank_errors(skewed, once, "g", "x").collect()
    assert len(rows) == 3 * len(q.LEVELS)
    assert max(r["error"] for r in rows) <= q.rank_error()
    counts = {r["g"]: r["n"] for r in once.collect()}
    assert counts == {r["g"]: r["count"] for r in skewed.groupBy("g").count().collect()}


def test_min_and_max_are_exact_and_small_groups_too(spark):
    df = spark.createDataFrame([("a", float(i)) for i in range(101)] + [("b", 5.0)], "g string, x double")
    rows = {r["g"]: r for r in q.read(q.sketch(df, ["g"], "x"), (0.5,)).collect()}
    assert (rows["a"]["min"], rows["a"]["p50"], rows["a"]["max"], rows["a"]["n"]) == (0.0, 50.0, 100.0, 101)
    assert (rows["b"]["min"], rows["b"]["p50"], rows["b"]["max"]) == (5.0, 5.0, 5.0)


def test_nulls_nan_null_keys_and_empty(spark):
    df = spark.createDataFrame([("a", None), ("a", float("nan")), (None, 2.0), (None, None)], "g string, x double")
    fine = q.sketch(df, ["g"], "x")
    rows = {r["g"]: r for r in q.read(fine).collect()}
    assert rows["a"]["n"] == 0 and rows["a"]["p50"] is None and rows["a"]["max"] is None
    assert rows[None]["n"] == 1 and rows[None]["p50"] == 2.0
    whole = q.read(q.merge(fine, [])).collect()
    assert [(r["n"], r["p50"]) for r in whole] == [(1, 2.0)]
    assert q.read(q.sketch(df.limit(0), ["g"], "x")).count() == 0
    assert {r["g"] for r in q.rank_errors(df, q.read(fine), "g", "x").collect()} == {None}
