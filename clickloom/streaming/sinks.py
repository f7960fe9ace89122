"""Update-mode output of a stream to a topic."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.paths import join
from ..sources.topics import TopicSpec
from .levels import RevisionLog

AVAILABLE_NOW = "available-now"


def write_topic_stream(
    df: DataFrame,
    spec: TopicSpec,
    checkpoint: str,
    trigger: str = "5 seconds",
    compact_by: str | None = None,
) -> StreamingQuery:
    """Start writing ``df`` in update mode; changed rows are emitted again.

    A file topic gets one sub-directory per micro-batch.  A batch that runs
    again after a failure replaces its own directory, so nothing is doubled.
    With ``compact_by``, a field of the JSON value, the batches are compacted
    into levelled runs (``RevisionLog``) and earlier revisions go.
    """
    writer = df.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
    if trigger == AVAILABLE_NOW:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=trigger)
    if spec.format == "kafka":
        return writer.format("kafka").options(**spec.options).start()

    if compact_by is not None:
        log = RevisionLog(df.sparkSession, spec, compact_by)
        return writer.foreachBatch(log.append).start()

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        target = join(spec.path, f"batch_id={batch_id}")
        out = batch.write.format(spec.format).options(**spec.options)
        out.mode("overwrite").save(target)

    return writer.foreachBatch(write_batch).start()


def read_compacted(spark: SparkSession, spec: TopicSpec, key: str) -> DataFrame:
    """A file topic written with ``compact_by``: ``value`` and its ``revision``."""
    return RevisionLog(spark, spec, key).read()


def read_updates(spark: SparkSession, spec: TopicSpec) -> DataFrame:
    """A file topic written by ``write_topic_stream``, with its ``batch_id``."""
    messages = spark.read.format(spec.format).schema("value string, topic string, batch_id bigint")
    return messages.load(spec.path).select(F.col("value"), F.col("batch_id"))
