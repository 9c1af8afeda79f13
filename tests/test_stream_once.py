"""A restarted scoring stream gives each review once."""

import os

import pytest
from pyspark.sql import functions as F

from revlens.streaming.scoring import batch_folder, read_scored, start_scoring_once, write_batch

SCHEMA = "id long, review_body string, arrived timestamp"


@pytest.fixture(scope="module")
def model(spark):
    from revlens.models.candidates import ngram_lr_pipeline, with_label
    rows = [(i, ["good fine", "bad poor", "so so"][i % 3], [1, -1, 0][i % 3]) for i in range(30)]
    return ngram_lr_pipeline(max_iter=3, num_features=256).fit(
        with_label(spark.createDataFrame(rows, "id long, review_body string, sentiment int")))


def deliver(spark, folder, name, ids, day=1):
    rows = [(i, f"good text {i}") for i in ids]
    (spark.createDataFrame(rows, "id long, review_body string")
     .withColumn("arrived", F.to_timestamp(F.lit(f"2024-01-{day:02d} 00:00:00")))
     .coalesce(1).write.parquet(os.path.join(folder, name)))


def stream(spark, folder):
    return (spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(os.path.join(folder, "*")))


def times(spark, sink):
    return {r["id"]: r["count"] for r in read_scored(spark, sink).groupBy("id").count().collect()}


def test_crash_after_a_written_batch_and_repeated_delivery(spark, tmp_dir, model):
    arriving, sink, ckpt = (os.path.join(tmp_dir, n) for n in ("in", "out", "ckpt"))
    deliver(spark, arriving, "a", range(0, 20))
    deliver(spark, arriving, "b", range(10, 30))

    def crash(scored, path, batch):
        write_batch(scored, path, batch)
        if batch == 1:
            raise RuntimeError("lost the driver after writing")

    with pytest.raises(Exception, match="lost the driver"):
        start_scoring_once(model, stream(spark, arriving), sink, ckpt, write=crash).awaitTermination()
    assert set(times(spark, sink).values()) == {1}

    def half(scored, path, batch):
        write_batch(scored.limit(3), path, batch)
        raise RuntimeError("half a batch")

    with pytest.raises(Exception, match="half a batch"):
        start_scoring_once(model, stream(spark, arriving), sink, ckpt, write=half).awaitTermination()
    deliver(spark, arriving, "c", range(0, 35), day=2)
    start_scoring_once(model, stream(spark, arriving), sink, ckpt).awaitTermination()
    assert times(spark, sink) == {i: 1 for i in range(35)}
    start_scoring_once(model, stream(spark, arriving), sink, ckpt).awaitTermination()
    assert times(spark, sink) == {i: 1 for i in range(35)}


def test_after_the_watermark_a_review_counts_as_new(spark, tmp_dir, model):
    arriving, sink, ckpt = (os.path.join(tmp_dir, n) for n in ("in", "out", "ckpt"))
    for name, ids, day in (("a", [1, 2], 1), ("b", [3], 20), ("c", [4], 21), ("d", [1], 22)):
        deliver(spark, arriving, name, ids, day)
        start_scoring_once(model, stream(spark, arriving), sink, ckpt).awaitTermination()
    assert times(spark, sink) == {1: 2, 2: 1, 3: 1, 4: 1}


def test_batches_overwrite_their_own_folder(spark, tmp_dir):
    rows = spark.createDataFrame([(1, "x")], "id long, prediction string")
    for _ in range(2):
        write_batch(rows, tmp_dir, 4)
    assert os.path.isdir(batch_folder(tmp_dir, 4)) and read_scored(spark, tmp_dir).collect()[0]["batch"] == 4
    assert read_scored(spark, tmp_dir).count() == 1
