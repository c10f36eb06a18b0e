"""Scoring a stream of message files with a stored model."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..ml.score import links_of_predicted_labels, score


def score_stream(
    spark: SparkSession, model: PipelineModel, source: str, schema: T.StructType, sink: str, checkpoint: str,
    keep: list[str], files_per_batch: int = 1000,
):
    """Starts scoring parquet files that arrive under ``source``; available files first, then it ends.

    Each micro-batch replaces its own folder, so a batch that is run again after a failure
    leaves no second copy. The model is stateless: no watermark, no state store.
    """
    incoming = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)

    def write(batch: DataFrame, batch_id: int) -> None:
        score(model, batch, keep).write.mode("overwrite").parquet(f"{sink}/batch={batch_id}")

    return (
        incoming.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def link_stream(
    spark: SparkSession, model, source: str, schema: T.StructType, sink: str, checkpoint: str, key: str, labels: list[str],
    links: DataFrame, prepare=lambda rows: rows, files_per_batch: int = 1000,
):
    """Starts predicting all labels of the parquet files that arrive under ``source`` and joining the links of the predicted ones.

    The join is one of a stream with a static table. Each micro-batch replaces its own folder, as in ``score_stream``.
    """
    incoming = prepare(spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source))
    found = links_of_predicted_labels(model, incoming, key, labels, links)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink}/batch={batch_id}")

    return found.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
