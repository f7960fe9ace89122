"""Users x items matrix as dated, incrementally merged snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.matrix import distinct_values, max_event_date, to_wide
from ..sinks.snapshots import add_wide, commit_counts
from ..sources.files import read_events_dir
from ..sources.paths import recover, staging
from ..sources.snapshots import latest_snapshot, read_dated_counts, read_snapshot_counts

KINDS = ("buy", "view")


REPLACE, ADD = "replace", "add"


def dated_counts(events: DataFrame) -> DataFrame:
    """Counts per user, item and date; rows without a date have the empty text.

    Rows without uid stay as a null key: they count for the newest date only.
    """
    date = F.coalesce("date", F.lit("")).alias("date")
    return events.groupBy("uid", "item_id", date).agg(F.count("*").alias("n"))


def merge_dated(old: DataFrame, new: DataFrame, same_date: str) -> DataFrame:
    """Counts of two periods; a date both have is the new one's, or the sum of both."""
    if same_date == ADD:
        keys = ("uid", "item_id", "date")
        return old.unionByName(new).groupBy(*keys).agg(F.sum("n").alias("n"))
    if same_date != REPLACE:
        raise ValueError(f"same_date is {REPLACE!r} or {ADD!r}, not {same_date!r}")
    dates = new.where("date <> ''").select("date").distinct()
    return old.join(dates, "date", "left_anti").unionByName(new)


def update_users_items(
    spark: SparkSession,
    input_dir: str,
    output_dir: str,
    update: bool = True,
    same_date: str = REPLACE,
    wide: bool = True,
    since: str | None = None,
) -> str | None:
    """Count ``input_dir`` and write a snapshot of the counts.

    With ``update`` the counts are merged into the newest snapshot in
    ``output_dir``, if there is one: a date of the input replaces what the
    snapshot has of that date (so a job may run again), or with
    ``same_date='add'`` adds to it.  The snapshot is named after the newest date
    of the input or, for a late batch, of the snapshot merged into, whichever is
    later.  ``since`` reads only input dates from that day on.

    The long counts are committed first.  ``wide`` also writes the matrix with
    one column per item; where a table cannot have the columns this fails and
    the long snapshot stays.  Returns the path written, or None when the input
    holds no events.  The events are parsed once: their counts are written to a
    staging table, and all later steps read that.
    """
    recover(spark, output_dir)
    buy, view = (read_events_dir(spark, input_dir, kind, since=since) for kind in KINDS)
    staged = staging(spark, output_dir)
    try:
        fresh_dir = staged.child("fresh")
        dated_counts(buy.unionByName(view)).write.parquet(fresh_dir.path)
        fresh = spark.read.parquet(fresh_dir.path)
        date = max_event_date(fresh.where("date <> ''"))
        if date is None:
            return None
        counts = fresh.where(F.col("uid").isNotNull() & F.col("item_id").isNotNull())
        last = latest_snapshot(spark, output_dir) if update else None
        if last is not None:
            old = read_dated_counts(spark, output_dir, last, "uid", "item_id")
            counts = merge_dated(old, counts, same_date)
            date = max(date, last, key=int)
        counts_dir = staged.child("counts")
        counts.write.parquet(counts_dir.path)
        target = commit_counts(spark, counts_dir, output_dir, date)
        if wide:
            counts = read_snapshot_counts(spark, output_dir, date, "uid", "item_id")
            items = distinct_values(counts, "item_id")
            add_wide(to_wide(counts, "uid", "item_id", items), target)
        return target.path
    finally:
        staged.delete()
