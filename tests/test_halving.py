"""Successive halving: nested samples, the right survivors, defined cases."""

import pytest
from pyspark.sql import functions as F

from revlens.models.halving import PLACES, halve_ngram_lr, place, shares, successive_halving


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(800).select("id", (F.col("id") % 3 - 1).cast("int").alias("sentiment"),
                                   F.element_at(F.array(F.lit("bad poor"), F.lit("so so"), F.lit("good fine")),
                                                (F.col("id") % 3 + 1).cast("int")).alias("review_body"))


def test_shares_end_with_all_rows():
    assert shares(8, 2) == [0.125, 0.25, 0.5, 1.0] and shares(9, 3) == [1 / 9, 1 / 3, 1.0]
    assert shares(1, 2) == [1.0] and shares(5, 2) == [0.125, 0.25, 0.5, 1.0] and shares(0, 2) == []


def test_samples_are_nested_whatever_the_layout_and_the_best_wins(rows):
    seen = []

    def fit(setting, sample):
        ids = {r["id"] for r in sample.select("id").collect()}
        seen.append((setting, ids))
        return setting

    found = successive_halving(rows.repartition(5), rows, {f"s{i}": i for i in range(8)}, fit,
                               lambda model, _: {5: 0.9, 2: 0.9, 7: 0.8, 1: 0.7}.get(model, 0.1))
    sizes = [len(ids) for _, ids in seen]
    assert [s for s, _ in seen] == [0, 1, 2, 3, 4, 5, 6, 7, 1, 2, 5, 7, 2, 5, 2]
    assert found.best == "s2" and found.model == 2  # a tie goes to the first
    samples = sorted({len(ids): ids for _, ids in seen}.items())
    assert all(a[1] < b[1] for a, b in zip(samples, samples[1:])) and sizes[-1] == 800
    whole = {r["id"]: r["p"] for r in rows.select("id", place("id").alias("p")).collect()}
    assert samples[0][1] == {i for i, p in whole.items() if p < PLACES / 8}
    kept = [(r[0], r[1]) for r in found.rows if r[4]]
    assert kept == [(0, "s1"), (0, "s2"), (0, "s5"), (0, "s7"), (1, "s2"), (1, "s5"), (2, "s2"), (3, "s2")]


def test_samples_that_cannot_be_fitted(spark, rows):
    one = rows.withColumn("sentiment", F.lit(1))
    found = successive_halving(one, one, {"a": 1, "b": 2}, lambda s, r: s, lambda m, r: 1.0)
    assert found.best == "a" and found.model is None and all(r[3] is None for r in found.rows)
    assert successive_halving(rows.limit(0), rows, {"a": 1}, lambda s, r: s, lambda m, r: 1.0).model is None
    assert successive_halving(rows, rows, {}, None, None).table(spark).count() == 0
    with pytest.raises(ValueError):
        successive_halving(rows, rows, {"a": 1}, None, None, eta=1)


def test_ngram_settings(spark, rows):
    grid = {"none": {"max_iter": 1, "num_features": 16, "reg_param": 100.0, "max_n": 2},
            "plain": {"max_iter": 5, "num_features": 256, "reg_param": 0.01, "max_n": 2}}
    found = halve_ngram_lr(rows, rows, grid)
    table = found.table(spark)
    assert found.best == "plain" and table.count() == 3
    assert table.where("rung = 1").first()["accuracy"] == 1.0 and found.model is not None
