"""Mergeable quantile sketches of a column, kept per group.

``sketch`` reads the rows once and leaves one small binary (KLL) per group;
``merge`` rolls groups up, or joins days or shards, without rereading rows;
``read`` gives quantiles.  A quantile's rank is off by at most
``rank_error(k)`` of the group's rows with 99 % confidence, whatever the values.

Defined cases: null and NaN values are left out; a group of such values alone has
n 0 and null quantiles; null keys are a group; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Sketch size: a group's binary stays below about 8 * (3 * K) bytes.
K = 800
LEVELS = (0.1, 0.25, 0.5, 0.75, 0.9, 0.99)


def rank_error(k: int = K) -> float:
    """Published fit of the normalised rank error of single quantiles, 99 % confidence."""
    return 2.296 / k ** 0.9723


def _value(col: str) -> Column:
    x = F.col(col).cast("double")
    return F.when(~F.isnan(x), x)


def sketch(df: DataFrame, keys: list[str], col: str, k: int = K) -> DataFrame:
    """keys, sketch, low, high: one row per group."""
    x = _value(col)
    return df.groupBy(*keys).agg(F.kll_sketch_agg_double(x, F.lit(k)).alias("sketch"),
                                 F.min(x).alias("low"), F.max(x).alias("high"))


def merge(sketches: DataFrame, keys: list[str], k: int = K) -> DataFrame:
    """Sketches of coarser groups (no keys: of everything)."""
    return sketches.groupBy(*keys).agg(F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"),
                                       F.min("low").alias("low"), F.max("high").alias("high"))


def read(sketches: DataFrame, levels=LEVELS) -> DataFrame:
    """keys, n, min, one column per level (p50, p99 ...), max."""
    keys = [c for c in sketches.columns if c not in ("sketch", "low", "high")]
    n = F.kll_sketch_get_n_double("sketch")
    # Low and high are exact and null for a group without values, whose sketch can't be asked.
    own = [F.when(F.col("low").isNotNull(), F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))))
           .alias(f"p{round(p * 100)}") for p in levels]
    return sketches.select(*keys, n.alias("n"), F.col("low").alias("min"), *own, F.col("high").alias("max"))


def rank_errors(df: DataFrame, quantiles: DataFrame, key: str, col: str, levels=LEVELS) -> DataFrame:
    """key, level, error: how far each quantile's rank in the rows lies from its
    level, as a share of the group's rows (0 while the level lies within ties).

    One scan; ``quantiles`` has a row per group and is broadcast only if small."""
    from revlens.operators.joins import small_local_copy
    names = [f"p{round(p * 100)}" for p in levels]
    few, found = small_local_copy(quantiles.select(F.col(key).alias("_key"), *names))
    side = few if found is None else F.broadcast(few)
    x = _value(col)
    counts = df.join(side, F.col(key).eqNullSafe(F.col("_key"))).groupBy("_key").agg(
        F.count(x).alias("n"),
        *[F.count(F.when(x < F.col(c), 1)).alias(f"below_{c}") for c in names],
        *[F.count(F.when(x <= F.col(c), 1)).alias(f"upto_{c}") for c in names])
    each = F.explode(F.array(*[
        F.struct(F.lit(float(p)).alias("level"),
                 F.greatest(F.lit(0.0), F.try_divide(F.col(f"below_{c}"), F.col("n")) - p,
                            p - F.try_divide(F.col(f"upto_{c}"), F.col("n"))).alias("error"))
        for p, c in zip(levels, names)])).alias("e")
    return counts.where("n > 0").select(F.col("_key").alias(key), each).select(key, "e.level", "e.error")
