"""Message envelope: a ``value`` column that carries one JSON document."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import EVENT_MESSAGE
from .clock import readable
from .naming import quoted

# Wide enough for any BIGINT, with six digits of a fraction.
NUMBER = "decimal(25,6)"


def decode_payload(df: DataFrame, schema: T.StructType, keep: Sequence[str] = ()) -> DataFrame:
    """Bytes or text ``value`` to top-level columns; broken JSON gives nulls.

    ``keep`` names envelope columns (offset, partition, ...) to carry along.
    """
    decoded = F.from_json(F.col("value").cast("string"), schema)
    return df.select(*keep, decoded.alias("v")).select(*keep, "v.*")


def decode_events(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Shop event messages; numbers may travel as numbers or as text.

    ``timestamp`` becomes a number, ``item_price`` stays text as the split
    output writes it.
    """
    return number_timestamps(decode_payload(df, EVENT_MESSAGE, keep))


# Reasons for which a message is rejected.
BROKEN, UNKNOWN_KIND, BAD_TIME = "broken JSON", "unknown kind", "bad time"
_CORRUPT = "_corrupt_record"


def decode_with_reason(
    df: DataFrame, kinds: Sequence[str] | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """``decode_events`` for every message, with its ``value`` as text and a ``reason`` to reject it.

    ``reason`` is null for a good message; the first of these counts: no JSON
    object can be read (a null or empty value has none), the kind is not one of
    ``kinds`` (where they are given), the time is missing or unreadable.
    """
    schema = T.StructType([*EVENT_MESSAGE.fields, T.StructField(_CORRUPT, T.StringType())])
    text = F.col("value").cast("string")
    decoded = F.from_json(text, schema, {"columnNameOfCorruptRecord": _CORRUPT})
    fields = df.select(*keep, text.alias("value"), decoded.alias("v"))
    events = fields.select(*keep, "value", F.col("v").isNull().alias("_none"), "v.*")
    broken = F.col("_none") | F.col(_CORRUPT).isNotNull()
    known = F.lit(True) if kinds is None else F.col("event_type").isin(list(kinds))
    reason = (
        F.when(broken, BROKEN)
        .when(~F.coalesce(known, F.lit(False)), UNKNOWN_KIND)
        .when(readable(F.col("timestamp")).isNull(), BAD_TIME)
    )
    return number_timestamps(events).withColumn("reason", reason).drop("_none", _CORRUPT)


def whole_number(value: Column) -> Column:
    """Number or numeric text as BIGINT, a fraction cut off downwards; null where it is none."""
    return F.floor(value.try_cast(NUMBER)).try_cast("bigint")


def price(value: Column) -> Column:
    """Number or numeric text as an exact decimal; null where it is none."""
    return value.try_cast(NUMBER)


def number_timestamps(events: DataFrame) -> DataFrame:
    """``timestamp`` given as text to a number; null where it is none."""
    return events.withColumn("timestamp", whole_number(F.col("timestamp")))


def encode_payload(df: DataFrame, columns: Sequence[str], topic: str | None = None) -> DataFrame:
    """Pack ``columns`` into one JSON ``value``; null fields are left out.

    With ``topic`` a constant column of that name routes the message.
    """
    packed = F.to_json(F.struct(*[F.col(quoted(c)) for c in columns])).alias("value")
    if topic is None:
        return df.select(packed)
    return df.select(packed, F.lit(topic).alias("topic"))
