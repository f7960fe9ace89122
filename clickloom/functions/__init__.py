"""Column functions: expressions in, expressions out, all JVM-side built-ins."""

from .clock import event_date, event_time, utc_hour, utc_weekday, visit_indicators
from .naming import age_bucket, label, quoted, sql_text
from .payload import decode_events, decode_payload, decode_with_reason, encode_payload, price
from .urls import domain_of, unescape_url

__all__ = [
    "age_bucket",
    "decode_events",
    "decode_payload",
    "decode_with_reason",
    "domain_of",
    "encode_payload",
    "event_date",
    "event_time",
    "label",
    "price",
    "quoted",
    "sql_text",
    "unescape_url",
    "utc_hour",
    "utc_weekday",
    "visit_indicators",
]
