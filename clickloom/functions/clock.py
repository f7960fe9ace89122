"""UTC calendar expressions over epoch milliseconds.

They use integer arithmetic on the epoch value, so the result does not depend
on ``spark.sql.session.timeZone`` and an operator never has to change session
settings.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HOUR_MS = 3_600_000
DAY_MS = 24 * HOUR_MS

# Feature names by weekday, in the order 0 = Sunday .. 6 = Saturday.
WEEKDAYS = ("sun", "mon", "tue", "wed", "thu", "fri", "sat")
# Half-open hour ranges of the two fractions.
WORK_HOURS = (9, 18)
EVENING_HOURS = (18, 24)
# First and last millisecond of the years 1 to 9999.
FIRST_MS, LAST_MS = -62_135_596_800_000, 253_402_300_799_999


def _periods(ts_ms: Column, length_ms: int) -> Column:
    return F.floor(readable(ts_ms) / F.lit(length_ms))


def readable(ts_ms: Column) -> Column:
    """The instant, or null outside the years 1 to 9999: such a value is no time.

    Everything below goes by this rule, so one bad message is an unreadable
    time and never an error.
    """
    return F.when(ts_ms.between(FIRST_MS, LAST_MS), ts_ms)


def event_time(ts_ms: Column) -> Column:
    """Epoch milliseconds as a TIMESTAMP (an instant); null when unreadable."""
    return F.timestamp_millis(readable(ts_ms))


def event_date(ts_ms: Column) -> Column:
    """UTC date of an instant as ``yyyyMMdd`` text; null when unreadable."""
    day = F.date_add(F.lit("1970-01-01").cast("date"), _periods(ts_ms, DAY_MS).cast("int"))
    return F.date_format(day, "yyyyMMdd")


def utc_hour(ts_ms: Column) -> Column:
    """Hour of day 0..23 in UTC."""
    return F.pmod(_periods(ts_ms, HOUR_MS), F.lit(24)).cast("int")


def utc_weekday(ts_ms: Column) -> Column:
    """Day of week in UTC, 0 = Sunday (1970-01-01 was a Thursday)."""
    return F.pmod(_periods(ts_ms, DAY_MS) + F.lit(4), F.lit(7)).cast("int")


def in_hours(hour: Column, span: tuple[int, int]) -> Column:
    """True when ``hour`` lies in the half-open range ``span``."""
    return (hour >= span[0]) & (hour < span[1])


# Time feature by name: which calendar part it looks at and the value it counts.
TIME_FEATURES = {f"web_day_{name}": ("day", i) for i, name in enumerate(WEEKDAYS)} | {
    f"web_hour_{h}": ("hour", h) for h in range(24)
}


def visit_indicators(ts_ms: Column) -> list[Column]:
    """0/1 columns of one visit: weekdays, hours, work, evening and a constant 1."""
    hour = utc_hour(ts_ms)
    parts = {"day": utc_weekday(ts_ms), "hour": hour}
    conditions = {name: parts[part] == value for name, (part, value) in TIME_FEATURES.items()}
    conditions["web_work_hours"] = in_hours(hour, WORK_HOURS)
    conditions["web_evening_hours"] = in_hours(hour, EVENING_HOURS)
    flags = [
        F.when(condition, 1).otherwise(0).cast("bigint").alias(name)
        for name, condition in conditions.items()
    ]
    return [*flags, F.lit(1).cast("bigint").alias("all_visits")]
