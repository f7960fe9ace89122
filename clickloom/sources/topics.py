"""Message topics, bounded and unbounded.

A broker is addressed by ``format='kafka'``.  Any file format that yields a
``value`` column (and, for numeric offsets, ``partition`` and ``offset``) can
stand in for it; the decoders downstream see no difference.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

EARLIEST = "earliest"

# Fixed value of the broker source: start of a partition.
_PARTITION_START = -2

ENVELOPE = T.StructType(
    [
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("value", T.StringType()),
    ]
)


@dataclass(frozen=True)
class TopicSpec:
    """A topic: its name, where it is, and how many partitions it has."""

    name: str
    format: str = "kafka"
    options: dict[str, str] = field(default_factory=dict)
    path: str | None = None
    partitions: int = 1


def starting_offsets(spec: TopicSpec, offset: str) -> str:
    """Broker setting for ``earliest``, ``latest`` or a number.

    A number holds for partition 0; every other partition starts at its
    beginning.
    """
    if not offset.isdigit():
        return offset
    starts = {str(p): _PARTITION_START for p in range(spec.partitions)}
    starts["0"] = int(offset)
    return json.dumps({spec.name: starts})


def read_topic_batch(
    spark: SparkSession, spec: TopicSpec, offset: str | int = EARLIEST
) -> DataFrame:
    """Everything in the topic from ``offset`` to its current end."""
    offset = str(offset)
    if spec.format == "kafka":
        bounds = {
            "subscribe": spec.name,
            "startingOffsets": starting_offsets(spec, offset),
            "endingOffsets": "latest",
        }
        return spark.read.format("kafka").options(**{**spec.options, **bounds}).load()
    if spec.format == "text":
        if offset != EARLIEST:
            raise ValueError("a text stand-in has no offsets")
        return spark.read.format("text").options(**spec.options).load(spec.path)
    if offset != EARLIEST and not offset.isdigit():
        raise ValueError(f"offset {offset!r}: a file topic knows {EARLIEST!r} and numbers")
    messages = spark.read.format(spec.format).schema(ENVELOPE).options(**spec.options)
    messages = messages.load(spec.path)
    if not offset.isdigit():
        return messages
    return messages.where((F.col("partition") != 0) | (F.col("offset") >= int(offset)))


def read_topic_stream(spark: SparkSession, spec: TopicSpec) -> DataFrame:
    """The topic from its beginning on, without end."""
    if spec.format == "kafka":
        bounds = {"subscribe": spec.name, "startingOffsets": EARLIEST}
        return spark.readStream.format("kafka").options(**{**spec.options, **bounds}).load()
    reader = spark.readStream.format(spec.format).options(**spec.options)
    if spec.format != "text":
        reader = reader.schema(ENVELOPE)
    return reader.load(spec.path)
