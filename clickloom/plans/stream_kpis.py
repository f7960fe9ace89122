"""Hourly shop KPIs from a topic to a topic."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..functions.clock import readable
from ..functions.payload import decode_events, encode_payload, price
from ..operators.kpis import EARLIEST, window_kpis
from ..sources.paths import Directory, join
from ..sources.topics import TopicSpec, read_topic_batch, read_topic_stream
from ..streaming.sinks import AVAILABLE_NOW, write_topic_stream

#: Field of a KPI message that names its window.
WINDOW_KEY = "start_ts"
_ORIGIN, _ORIGIN_FILE = "origin", "origin.json"


def kpi_messages(
    messages: DataFrame,
    topic: str | None,
    length: str = "1 hour",
    watermark: str | None = None,
    start: int | str | None = None,
) -> DataFrame:
    """Event messages to KPI messages; works on batch and stream alike.

    ``start`` aligns the windows as ``window_kpis`` does.
    """
    events = decode_events(messages).withColumn("item_price", price(F.col("item_price")))
    kpis = window_kpis(events, length, start, watermark)
    return encode_payload(kpis, schemas.KPI_COLUMNS, topic)


def earliest(messages: DataFrame) -> int | None:
    """Time of the earliest event with a readable time, in epoch milliseconds."""
    times = decode_events(messages).select(readable(F.col("timestamp")).alias("t"))
    return times.agg(F.min("t")).first()[0]


def stream_origin(
    spark: SparkSession, source: TopicSpec, checkpoint: str, trigger: str = "5 seconds"
) -> int | None:
    """Where the windows of a stream from the earliest event begin; found once, then kept.

    The first start takes the earliest event the topic holds; of an empty topic
    it waits for the first micro-batch with an event (and gives None where the
    trigger ends before).  The instant is kept with the checkpoint, so a restart
    goes on with the same windows.  An earlier event that comes later does not
    move them: it lies in the window before, at the same distance of lengths.
    """
    kept = Directory(spark, join(checkpoint, _ORIGIN))
    if _ORIGIN_FILE in kept.files():
        return json.loads(kept.read_text(_ORIGIN_FILE))["origin"]
    origin = earliest(read_topic_batch(spark, source))
    if origin is None:
        origin = _first_event(spark, source, join(kept.path, f"_search-{uuid.uuid4().hex}"), trigger)
    if origin is not None:
        draft = f"_draft-{uuid.uuid4().hex}"
        kept.write_text(draft, json.dumps({"origin": origin}))
        kept.rename_file(draft, _ORIGIN_FILE)
    return origin


def _first_event(spark: SparkSession, source: TopicSpec, checkpoint: str, trigger: str) -> int | None:
    found: list[int] = []

    def look(batch: DataFrame, _: int) -> None:
        if not found and (origin := earliest(batch)) is not None:
            found.append(origin)

    writer = read_topic_stream(spark, source).writeStream.foreachBatch(look)
    writer = writer.option("checkpointLocation", checkpoint)
    bounded = trigger == AVAILABLE_NOW
    query = (writer.trigger(availableNow=True) if bounded else writer.trigger(processingTime=trigger)).start()
    try:
        while not found and not query.awaitTermination(1):
            pass
    finally:
        query.stop()
        Directory(spark, checkpoint).delete()
    return found[0] if found else None


def stream_kpis(
    spark: SparkSession,
    source: TopicSpec,
    sink: TopicSpec,
    checkpoint: str,
    length: str = "1 hour",
    trigger: str = "5 seconds",
    watermark: str | None = None,
    start: int | str | None = None,
    compact: bool = False,
) -> StreamingQuery:
    """Start the stream; every window is re-emitted whenever it changes.

    ``start`` (epoch milliseconds) is where the first window begins;
    ``'earliest'`` takes that from the stream as ``stream_origin`` says.
    ``compact`` keeps a file topic as levelled runs by window start.
    """
    if start == EARLIEST:
        start = stream_origin(spark, source, checkpoint, trigger)
    messages = read_topic_stream(spark, source)
    updates = kpi_messages(messages, sink.name, length, watermark, start)
    return write_topic_stream(updates, sink, checkpoint, trigger, WINDOW_KEY if compact else None)
