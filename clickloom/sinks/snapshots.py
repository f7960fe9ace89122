"""Dated parquet snapshots, replaced as a whole."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources.paths import Directory, recover, staging
from ..sources.snapshots import COUNTS, snapshot_path


def commit_counts(spark: SparkSession, counts: Directory, directory: str, date: str) -> Directory:
    """Put written long counts in place as the snapshot of ``date``; there is no wide form yet."""
    staged = staging(spark, directory)
    target = Directory(spark, snapshot_path(directory, date))
    try:
        counts.move_to(staged.child(COUNTS))
        staged.replace(target)
    finally:
        staged.delete()
    spark.catalog.refreshByPath(target.path)
    return target


def add_wide(wide: DataFrame, target: Directory) -> None:
    """Write the wide form into a committed snapshot; executors commit the files."""
    wide.write.mode("append").parquet(target.path)
    wide.sparkSession.catalog.refreshByPath(target.path)


def write_snapshot(
    df: DataFrame, directory: str, date: str, counts: Directory | None = None
) -> str:
    """Write ``df`` to ``directory/date``, replacing what is there.

    The files are written beside the target and moved in when complete, so
    ``df`` may read the snapshot it replaces.  ``counts`` is a written long
    form to be kept with the snapshot.
    """
    spark = df.sparkSession
    recover(spark, directory)
    staged = staging(spark, directory)
    target = Directory(spark, snapshot_path(directory, date))
    try:
        df.write.parquet(staged.path)
        if counts is not None:
            counts.move_to(staged.child(COUNTS))
        staged.replace(target)
    finally:
        staged.delete()
    # The files behind this path have changed under any cached listing.
    spark.catalog.refreshByPath(target.path)
    return target.path
