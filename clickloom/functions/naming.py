"""Names and buckets: column-name normaliser, age categories, quoting.

Wide tables build their column lists as SQL text (``quoted``, ``sql_text``):
one call to the JVM for the whole list instead of several per column.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lower bound of each age category, ascending; the last is open.
AGE_BUCKETS = ((18, "18-24"), (25, "25-34"), (35, "35-44"), (45, "45-54"), (55, ">=55"))


def label(prefix: str, value: Column) -> Column:
    """Lower-case ``value``, turn each whitespace or dash into ``_``, add ``prefix``."""
    return F.concat(F.lit(prefix), F.lower(F.regexp_replace(value, r"[\s-]", "_")))


def age_bucket(age: Column, max_age: int | None = None) -> Column:
    """Age category; null below 18, for null, and above ``max_age`` if given."""
    bucket = F.when(age < AGE_BUCKETS[0][0], F.lit(None).cast("string"))
    if max_age is not None:
        bucket = bucket.when(age > max_age, F.lit(None).cast("string"))
    for low, name in reversed(AGE_BUCKETS):
        bucket = bucket.when(age >= low, name)
    return bucket


def quoted(name: str) -> str:
    """Column name that Spark resolves literally, also with dots inside."""
    return "`" + name.replace("`", "``") + "`"


def sql_text(value: str) -> str:
    """SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
