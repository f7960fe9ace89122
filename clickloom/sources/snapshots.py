"""Dated matrix snapshots: ``directory/YYYYMMDD``.

The dated directory holds the wide matrix, if there is one.  Its hidden part
``_counts`` holds the same numbers in long form and per date, which the next
update reads; table readers skip hidden directories.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.matrix import distinct_values, to_long, to_wide
from .paths import Directory, join

COUNTS = "_counts"


def snapshot_path(directory: str, date: str) -> str:
    return join(directory, date)


def latest_snapshot(spark: SparkSession, directory: str) -> str | None:
    """Newest dated child (digits only, compared as numbers), or None."""
    dates = [name for name in Directory(spark, directory).children() if name.isdigit()]
    return max(dates, key=int, default=None)


def read_snapshot(spark: SparkSession, directory: str, date: str) -> DataFrame:
    """The wide matrix of one date, made from the long counts if it was not written."""
    if has_wide(spark, directory, date):
        return spark.read.parquet(snapshot_path(directory, date))
    counts = read_snapshot_counts(spark, directory, date, "uid", "item_id")
    return to_wide(counts, "uid", "item_id", distinct_values(counts, "item_id"))


def has_wide(spark: SparkSession, directory: str, date: str) -> bool:
    return Directory(spark, snapshot_path(directory, date)).has_files(".parquet")


def read_snapshot_counts(
    spark: SparkSession, directory: str, date: str, key: str, item: str, n: str = "n"
) -> DataFrame:
    """The long counts of one snapshot over all dates."""
    dated = read_dated_counts(spark, directory, date, key, item, n)
    return dated.groupBy(key, item).agg(F.sum(n).alias(n))


def read_dated_counts(
    spark: SparkSession, directory: str, date: str, key: str, item: str, n: str = "n"
) -> DataFrame:
    """The long counts of one snapshot by event date.

    Counts without a date, those of a snapshot that has the wide matrix only,
    have the empty text.
    """
    stored = Directory(spark, join(directory, date, COUNTS))
    if not stored.exists():
        wide = spark.read.parquet(snapshot_path(directory, date))
        return to_long(wide, key, item, n).select(key, item, F.lit("").alias("date"), n)
    counts = spark.read.parquet(stored.path)
    if "date" not in counts.columns:
        counts = counts.withColumn("date", F.lit(""))
    return counts.select(key, item, "date", n)
