"""Score reviews as they arrive: file stream -> fitted pipeline -> sink.

The fitted pipeline is stateless per row, so the streaming plan is the
batch plan applied to each micro-batch; ``availableNow`` processes what is
there and stops, a processing-time trigger keeps the query running.

``start_scoring_once`` gives each review once across restarts and repeated
deliveries.  Ids seen within the watermark are dropped by the state store
(kept in the stream's checkpoint).  Each batch overwrites the folder of its
own number, so a batch replayed after a crash, however far it came, replaces
its rows instead of adding to them.  Rows of one id within the watermark are
taken to be the same review (one of them is scored); null ids are one id, and
reviews repeated after the watermark has passed are scored again, since no
bounded state can know them.
"""

from __future__ import annotations

import os

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from revlens.models.candidates import score_reviews
from revlens.session import GROUP_BYTES


def review_stream(spark: SparkSession, path: str, schema: StructType | str,
                  fmt: str = "parquet", max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def start_scoring(model: PipelineModel, stream: DataFrame, sink_path: str, checkpoint_path: str,
                  text_col: str = "review_body", keep=("id",), available_now: bool = True,
                  processing_time: str | None = None, fmt: str = "parquet") -> StreamingQuery:
    scored = score_reviews(model, stream, text_col=text_col, keep=keep)
    writer = (scored.writeStream.format(fmt).outputMode("append").option("parquet.block.size", GROUP_BYTES)
              .option("path", sink_path).option("checkpointLocation", checkpoint_path))
    writer = (writer.trigger(availableNow=True) if available_now
              else writer.trigger(processingTime=processing_time or "10 seconds"))
    return writer.start()


def batch_folder(sink_path: str, batch: int) -> str:
    return os.path.join(sink_path, f"batch={batch}")


def write_batch(scored: DataFrame, sink_path: str, batch: int) -> None:
    """The batch's own folder, replaced whole; safe to repeat."""
    scored.write.mode("overwrite").parquet(batch_folder(sink_path, batch))


def start_scoring_once(model: PipelineModel, stream: DataFrame, sink_path: str, checkpoint_path: str,
                       text_col: str = "review_body", id_col: str = "id", time_col: str = "arrived",
                       watermark: str = "7 days", available_now: bool = True,
                       processing_time: str | None = None, write=write_batch) -> StreamingQuery:
    """Score each review once; ``time_col`` is the time that the watermark follows."""
    fresh = (stream.select(id_col, text_col, time_col).withWatermark(time_col, watermark)
             .dropDuplicatesWithinWatermark([id_col]))

    def each(rows: DataFrame, batch: int) -> None:
        write(score_reviews(model, rows, text_col=text_col, keep=(id_col,)), sink_path, batch)

    writer = fresh.writeStream.option("checkpointLocation", checkpoint_path).foreachBatch(each)
    writer = (writer.trigger(availableNow=True) if available_now
              else writer.trigger(processingTime=processing_time or "10 seconds"))
    return writer.start()


def read_scored(spark: SparkSession, sink_path: str) -> DataFrame:
    """All scored reviews, with the batch that scored them."""
    return spark.read.parquet(sink_path).withColumn("batch", F.col("batch").cast("long"))
