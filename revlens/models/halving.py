"""Successive halving over settings of a classifier.

Every setting is first fitted to a small sample of the training rows; the
better half (one in ``eta``) goes on to a sample ``eta`` times as large, and
the last are fitted to all rows.  Samples are nested: a row's place is a hash
of its id, and a larger sample keeps the rows of a smaller one, on any layout.
All settings of a rung see the same rows, and are measured on the whole
validation part.

Defined cases: ties go to the setting named first; a sample without rows, or
with one label only, can't be fitted and counts as accuracy null, behind all
others; without settings nothing is fitted.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from revlens.session import GROUP_BYTES, scratch_path, short_batches

#: Places of the hash; a sample takes those below its share of them.
PLACES = 1 << 30


@dataclass
class Halving:
    """rung, candidate, n_rows, accuracy, kept of every fit; the winner and its model."""

    rows: list[tuple] = field(default_factory=list)
    best: str | None = None
    model: object = None

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows, "rung int, candidate_name string, n_rows long, accuracy double, kept boolean")


def place(id_col: str, seed: int = 42) -> Column:
    return F.pmod(F.xxhash64(F.col(id_col), F.lit(seed)), F.lit(PLACES))


def shares(settings: int, eta: int) -> list[float]:
    """Share of the rows that each rung takes; the last takes all."""
    rungs = 1 + max(0, math.ceil(math.log(settings, eta) - 1e-9)) if settings else 0
    return [eta ** -float(rungs - 1 - r) for r in range(rungs)]


def successive_halving(train: DataFrame, validation: DataFrame, settings: Mapping[str, object],
                       fit: Callable[[object, DataFrame], object], accuracy: Callable[[object, DataFrame], float | None],
                       eta: int = 2, id_col: str = "id", label: str = "sentiment", seed: int = 42) -> Halving:
    """``fit(setting, rows)`` gives a model, ``accuracy(model, validation)`` its measure."""
    if eta < 2:
        raise ValueError("eta must be at least 2")
    out, left = Halving(), list(settings)
    placed = train.withColumn("__place", place(id_col, seed))
    for rung, share in enumerate(shares(len(left), eta)):
        sample = placed.where(F.col("__place") < int(share * PLACES)).drop("__place")
        n, labels = sample.where(F.col(label).isNotNull()).agg(F.count(F.lit(1)), F.count_distinct(label)).first()
        found = []
        for at, name in enumerate(left):
            model = fit(settings[name], sample) if labels > 1 else None
            right = accuracy(model, validation) if model is not None else None
            found.append((right is None, -(right or 0.0), at, name, model, right))
        ranked = sorted(found, key=lambda f: f[:3])
        last = share == 1.0
        kept = [f[3] for f in ranked[:1 if last else math.ceil(len(left) / eta)]]
        out.rows += [(rung, f[3], n, f[5], f[3] in kept) for f in found]
        if last:
            out.best, out.model = ranked[0][3], ranked[0][4]
        left = [name for name in left if name in kept]
    return out


def halve_ngram_lr(train: DataFrame, validation: DataFrame, grid: Mapping[str, dict], eta: int = 2) -> Halving:
    """Halving inside the n-gram logistic family; ``grid`` gives the pipeline's
    arguments (max_n, num_features, max_iter, reg_param) by name."""
    from revlens.models.candidates import accuracy, ngram_lr_pipeline, predict_sentiment, with_label
    spark = train.sparkSession
    pipelines = {name: ngram_lr_pipeline(**setting).getStages() for name, setting in grid.items()}
    # Settings that differ in the learner alone share their features.
    shapes = {name: (s[-2].getOrDefault("maxN"), s[-2].getNumFeatures()) for name, s in pipelines.items()}
    made = {shape: f"features_{i}" for i, shape in enumerate(dict.fromkeys(shapes.values()))}

    def featurised(df: DataFrame) -> DataFrame:
        """id, sentiment, label and the features of every shape, written once."""
        if not made:
            return df
        out = next(iter(pipelines.values()))[0].transform(with_label(df.select("id", "sentiment", "review_body")))
        for name, steps in pipelines.items():
            if made[shapes[name]] not in out.columns:
                out = steps[-2].copy({steps[-2].outputCol: made[shapes[name]]}).transform(out)
        path = scratch_path(spark, "features")
        out.drop("review_body", "tokens").write.option("parquet.block.size", GROUP_BYTES).parquet(path)
        return spark.read.parquet(path)

    def rows_of(name: str, rows: DataFrame) -> DataFrame:
        return rows.select("sentiment", "label", F.col(made[shapes[name]]).alias("features"))

    held = featurised(train), featurised(validation)
    with short_batches(spark):
        found = successive_halving(
            *held, {name: name for name in grid},
            lambda name, rows: (name, pipelines[name][-1].fit(rows_of(name, rows))),
            lambda fit, rows: accuracy(predict_sentiment(fit[1], rows_of(fit[0], rows))).first()["metric_value"], eta)
    if found.model is not None:
        name, model = found.model
        found.model = PipelineModel([*pipelines[name][:-1], model])
    return found
