"""Shop KPIs per time window, for batch and streaming DataFrames alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clock import event_time, readable
from ..schemas import KPI_COLUMNS

EARLIEST = "earliest"


def _measures() -> list[Column]:
    bought = F.col("event_type") == "buy"
    spent = F.when(bought, F.col("item_price")).otherwise(F.lit(0))
    return [
        # Prices may have a fraction: the sum is exact, then its whole part counts.
        F.sum(spent).cast("bigint").alias("revenue"),
        # Visits with a known user, not distinct users.
        F.count("uid").alias("visitors"),
        F.count_if(bought).alias("purchases"),
    ]


def window_kpis(
    events: DataFrame,
    length: str = "1 hour",
    start: int | str | None = None,
    watermark: str | None = None,
) -> DataFrame:
    """Revenue, visitors, purchases and average order value per tumbling window.

    Windows are aligned to the epoch.  ``start`` moves the alignment to an
    instant in epoch milliseconds or, for batch input, to the earliest event
    (``'earliest'``).  ``watermark`` bounds the state of a stream by dropping
    events that come later than that; by default all are counted.  Windows
    without events give no row; without purchases ``aov`` is null.
    """
    timed = events.withColumn("event_time", event_time(F.col("timestamp")))
    if watermark is not None:
        timed = timed.withWatermark("event_time", watermark)
    if start == EARLIEST:
        grouped = _from_earliest(timed, length)
    else:
        window = (
            F.window("event_time", length)
            if start is None
            else F.window("event_time", length, length, f"{_offset(start, length)} milliseconds")
        )
        grouped = timed.groupBy(window.alias("window")).agg(*_measures())
    return (
        grouped.withColumn("start_ts", F.unix_timestamp(F.col("window.start")))
        .withColumn("end_ts", F.unix_timestamp(F.col("window.end")))
        .withColumn("aov", F.try_divide(F.col("revenue"), F.col("purchases")))
        .select(*KPI_COLUMNS)
    )


def _length_ms(length: str) -> int:
    """Milliseconds of ``90 minutes 30 seconds`` and the like."""
    # Window units in milliseconds.
    units = {
        "millisecond": 1,
        "second": 1_000,
        "minute": 60_000,
        "hour": 3_600_000,
        "day": 86_400_000,
        "week": 604_800_000,
    }
    words = length.lower().removeprefix("interval ").split()
    return sum(int(n) * units[unit.rstrip("s")] for n, unit in zip(words[::2], words[1::2]))


def _offset(start: int, length: str) -> int:
    return start % _length_ms(length)


def _from_earliest(timed: DataFrame, length: str) -> DataFrame:
    span = F.lit(_length_ms(length))
    origin = timed.agg(F.min(readable(F.col("timestamp")))).scalar()
    elapsed = F.col("timestamp") - origin
    begin = origin + (elapsed - F.pmod(elapsed, span))
    window = F.struct(
        event_time(begin).alias("start"), event_time(begin + span).alias("end")
    ).alias("window")
    timed = timed.where(F.col("event_time").isNotNull())
    return timed.groupBy(window).agg(*_measures())


def latest_kpis(updates: DataFrame, version: str = "batch_id") -> DataFrame:
    """Last revision of every window of an update-mode output."""
    row = F.struct(*KPI_COLUMNS)
    return (
        updates.groupBy("start_ts")
        .agg(F.max_by(row, F.col(version)).alias("last"))
        .select("last.*")
    )
