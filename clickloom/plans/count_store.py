"""Users x items counts as immutable date partitions, named by a manifest.

Counts are kept long, one part per event date.  An update writes the dates of
its input and publishes a version that takes all other dates over by name, so
its cost goes with the input and not with the history.  Each version is a
snapshot; it is named after the newest date, as those of ``update_users_items``
are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.checks import observed
from ..operators.matrix import distinct_values, to_wide
from ..sources.files import read_events_dir
from ..versions import Version, VersionedFolder, partition_folders
from .users_items import ADD, KINDS, REPLACE, dated_counts

#: Part of the rows whose time is unreadable.
UNDATED = "undated"
#: Folders of one date beyond which they are made one again.
MAX_FOLDERS = 8

SCHEMA = "uid string, item_id string, date string, n bigint"


def _write(counts: DataFrame, store: VersionedFolder) -> dict[str, list[str]]:
    """Counts by date as fresh folders; the date stays in the rows, too."""
    folder = store.fresh()
    part = F.when(F.col("date") == "", UNDATED).otherwise(F.col("date")).alias("p_date")
    # Large dates are split by size, small ones are a file each; rows of a user lie together.
    rows = counts.select("uid", "item_id", "date", "n", part).hint("rebalance", F.col("p_date"))
    rows.sortWithinPartitions("p_date", "uid").write.partitionBy("p_date").parquet(store.path(folder))
    folders = partition_folders(store.spark, store.root, folder, "p_date")
    return {date: [path] for (date,), path in folders.items()}


def update_count_store(
    spark: SparkSession,
    input_dir: str,
    root: str,
    update: bool = True,
    same_date: str = REPLACE,
    since: str | None = None,
) -> Version | None:
    """Count ``input_dir`` and publish a version of the store in ``root``.

    A date of the input replaces what the store has of that date, or with
    ``same_date='add'`` is added to it; other dates are neither read nor
    written.  Rows without a date are always added.  ``update=False`` starts
    anew; the versions before stay readable.  The input is read once.  Returns
    the version, or None when the input holds no events; nothing is published
    then.
    """
    if same_date not in (REPLACE, ADD):
        raise ValueError(f"same_date is {REPLACE!r} or {ADD!r}, not {same_date!r}")
    store = VersionedFolder(spark, root)
    base = store.latest()
    buy, view = (read_events_dir(spark, input_dir, kind, since=since) for kind in KINDS)
    counts, seen = dated_counts(buy.unionByName(view)), Observation()
    # Anonymous rows are no matrix row, but they count for the date.
    newest = F.max("date").alias("newest")
    watched = counts.observe(seen, newest)
    fresh = _write(watched.where(F.col("uid").isNotNull() & F.col("item_id").isNotNull()), store)
    newest = observed(seen, counts, [newest])["newest"]
    if not newest:
        return None
    parts, notes = (dict(base.parts), base.notes) if update else ({}, {})
    for date, folders in fresh.items():
        adds = same_date == ADD or date == UNDATED
        parts[date] = [*parts.get(date, []), *folders] if adds else folders
    snapshot = max(newest, notes.get("snapshot", newest), key=int)
    return store.publish(base, parts, {"snapshot": snapshot})


def read_count_store(
    spark: SparkSession,
    root: str,
    version: Version | None = None,
    dates: Sequence[str] | None = None,
    since: str | None = None,
) -> DataFrame:
    """``(uid, item_id, date, n)`` of a version, the newest by default.

    ``dates`` and ``since`` choose parts by the manifest: other days are not
    even listed.  Added counts of a date are rows of their own.
    """
    store = VersionedFolder(spark, root)
    version = version or store.latest()
    names = [
        d for d in version.parts
        if (dates is None or d in dates) and (since is None or (d != UNDATED and d >= since))
    ]
    paths = store.paths(version, names)
    return spark.read.schema(SCHEMA).parquet(*paths) if paths else spark.createDataFrame([], SCHEMA)


def store_counts(spark: SparkSession, root: str, version: Version | None = None, **only) -> DataFrame:
    """Long counts ``(uid, item_id, n)`` of a version over its dates."""
    dated = read_count_store(spark, root, version, **only)
    return dated.groupBy("uid", "item_id").agg(F.sum("n").alias("n"))


def store_matrix(spark: SparkSession, root: str, version: Version | None = None) -> DataFrame:
    """The users x items matrix of a version, one column per item."""
    counts = store_counts(spark, root, version)
    return to_wide(counts, "uid", "item_id", distinct_values(counts, "item_id"))


def snapshot_version(spark: SparkSession, root: str, date: str) -> Version | None:
    """The last version that is the snapshot of ``date``."""
    store = VersionedFolder(spark, root)
    for number in reversed(store.numbers()):
        version = store.at(number)
        if version.notes.get("snapshot") == date:
            return version
    return None


def compact_count_store(spark: SparkSession, root: str, max_folders: int = MAX_FOLDERS) -> Version:
    """Add up the dates that have more than ``max_folders`` folders; only these are read and written."""
    store = VersionedFolder(spark, root)
    base = store.latest()
    many = [date for date, folders in base.parts.items() if len(folders) > max_folders]
    if not many:
        return base
    dated = spark.read.schema(SCHEMA).parquet(*store.paths(base, many))
    merged = dated.groupBy("uid", "item_id", "date").agg(F.sum("n").alias("n"))
    return store.publish(base, base.parts | _write(merged, store), base.notes)
