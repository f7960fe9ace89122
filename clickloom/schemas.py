"""Declared schemas of every input record (nothing is inferred from data)."""

from __future__ import annotations

from pyspark.sql import types as T

# Tab-separated web log line; unix seconds, percent-encoded URL.
WEBLOG = T.StructType(
    [
        T.StructField("uid", T.LongType()),
        T.StructField("ts", T.DoubleType()),
        T.StructField("url", T.StringType()),
    ]
)

CLIENT = T.StructType(
    [
        T.StructField("uid", T.StringType()),
        T.StructField("gender", T.StringType()),
        T.StructField("age", T.IntegerType()),
    ]
)

# Shop event as the engine works on it: numbers are numbers.
EVENT = T.StructType(
    [
        T.StructField("category", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("item_id", T.StringType()),
        T.StructField("item_price", T.LongType()),
        T.StructField("timestamp", T.LongType()),
        T.StructField("uid", T.StringType()),
    ]
)

# Shop event as it travels: producers write price and time as numbers or as
# text.  Reading them as text takes both.
EVENT_MESSAGE = T.StructType([T.StructField(name, T.StringType()) for name in EVENT.names])

SPLIT_EVENT = T.StructType([*EVENT_MESSAGE.fields, T.StructField("date", T.StringType())])

VISITS = T.ArrayType(
    T.StructType(
        [
            T.StructField("timestamp", T.LongType()),
            T.StructField("url", T.StringType()),
        ]
    )
)

# One row per user; timestamps are epoch milliseconds.
USER_VISITS = T.StructType(
    [
        T.StructField("uid", T.StringType()),
        T.StructField("visits", VISITS),
    ]
)

DOMAIN_CATEGORY = T.StructType(
    [
        T.StructField("domain", T.StringType()),
        T.StructField("category", T.StringType()),
    ]
)

KPI = T.StructType(
    [
        T.StructField("start_ts", T.LongType()),
        T.StructField("end_ts", T.LongType()),
        T.StructField("revenue", T.LongType()),
        T.StructField("visitors", T.LongType()),
        T.StructField("purchases", T.LongType()),
        T.StructField("aov", T.DoubleType()),
    ]
)

KPI_COLUMNS = KPI.fieldNames()


def segment(field: str = "autousers") -> T.StructType:
    """One document holding one array of user ids."""
    return T.StructType([T.StructField(field, T.ArrayType(T.StringType()))])
