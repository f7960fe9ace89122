"""Topic to per-kind, per-date event files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.payload import decode_events, decode_with_reason
from ..operators.checks import KindChecks
from ..sinks.split import KINDS, MOVED, split_by_kind, split_messages
from ..sources.topics import EARLIEST, TopicSpec, read_topic_batch


def split_events(
    spark: SparkSession,
    topic: TopicSpec,
    output: str,
    offset: str | int = EARLIEST,
    kinds: Sequence[str] = KINDS,
    rebalance: bool = True,
    layout: str = MOVED,
) -> None:
    """Decode the topic from ``offset`` on and split it by kind and UTC date."""
    messages = read_topic_batch(spark, topic, offset)
    split_by_kind(decode_events(messages), output, kinds, rebalance, layout)


def split_topic(
    spark: SparkSession,
    topic: TopicSpec,
    output: str,
    offset: str | int = EARLIEST,
    kinds: Sequence[str] = KINDS,
    rebalance: bool = True,
) -> DataFrame:
    """``split_events`` that loses nothing: messages that do not belong in the output are kept with the reason.

    One pass over the topic writes the kinds and the rejected messages as one
    version.  Returns ``kind_checksums`` of the accepted rows, taken in that
    same pass; the kind null stands for all rejected ones.
    """
    decoded = decode_with_reason(read_topic_batch(spark, topic, offset), kinds)
    checks = KindChecks(kinds)
    kind = F.when(F.col("reason").isNull(), F.col("event_type"))
    split_messages(checks.watch(decoded.withColumn("event_type", kind)), output, rebalance)
    return checks.result(spark)
