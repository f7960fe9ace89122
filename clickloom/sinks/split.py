"""Split events by kind and UTC date."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.clock import event_date
from ..sources.paths import Directory, join, recover, staging
from ..versions import VERSIONS as MANIFESTS
from ..versions import Version, VersionedFolder, partition_folders

KINDS = ("view", "buy")
# ``partitions`` is the former name of ``versions``.
MOVED, VERSIONS, PARTITIONS = "moved", "versions", "partitions"
READY = "_ready-"
# Kind of the parts that hold rejected messages.
REJECTED = "_rejected"
# Versions of the output that stay readable: the new one and the one before.
KEEP = 2

# Field order of an output line; numbers that travel as text stay text.
OUTPUT_FIELDS = (
    "category",
    "event_type",
    "item_id",
    "item_price",
    "timestamp",
    "uid",
    "date",
)


def dated_events(events: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Events in output form: price as text, UTC ``date`` of the message added."""
    return (
        events.withColumn("item_price", F.col("item_price").cast("string"))
        .withColumn("date", event_date(F.col("timestamp")))
        .select(*OUTPUT_FIELDS, *keep)
    )


def split_by_kind(
    events: DataFrame,
    path: str,
    kinds: Sequence[str] = KINDS,
    rebalance: bool = True,
    layout: str = MOVED,
) -> None:
    """JSON lines under ``path/<kind>/p_date=YYYYMMDD``; other kinds are dropped.

    The input is read once: one write partitioned by kind and date goes to a
    staging directory, which is renamed when complete and whose kinds are then
    moved to their places.  A job that dies between two moves is finished by the
    next one on this path, so no new kind is left beside an old one.  With
    ``layout='versions'`` the executors commit a fresh folder and one renamed
    manifest publishes it: nothing is moved, which object stores would do by
    copying, and nothing is overwritten, so a write that fails at any point
    leaves all old rows and ``events`` may be read from ``path``; the version
    before stays for readers that have begun.  ``rebalance`` adds a shuffle that
    merges small files and, unlike a plain repartition by date, splits a date
    that holds much of the data; leave it out when each input partition already
    holds few dates.
    """
    if layout not in (MOVED, VERSIONS, PARTITIONS):
        raise ValueError(f"layout is {MOVED!r} or {VERSIONS!r}, not {layout!r}")
    spark = events.sparkSession
    rows = (
        dated_events(events.where(F.col("event_type").isin(*kinds)))
        .withColumn("kind", F.col("event_type"))
        .withColumn("p_date", F.col("date"))
    )
    if rebalance:
        rows = rows.hint("rebalance", F.col("kind"), F.col("p_date"))
    if layout != MOVED:
        publish_split(rows, path)
        return
    if Directory(spark, join(path, MANIFESTS)).exists():
        raise ValueError(f"{path} has versions: write it with layout={VERSIONS!r}")
    finish_split(spark, path)
    staged = staging(spark, path)
    try:
        rows.write.partitionBy("kind", "p_date").json(staged.path)
        for kind in kinds:
            staged.child(f"kind={kind}").create()
        # From this rename on the output is the new one.
        staged.move_to(Directory(spark, join(path, READY + uuid.uuid4().hex)))
        finish_split(spark, path)
    finally:
        staged.delete()


def split_messages(decoded: DataFrame, path: str, rebalance: bool = True) -> Version:
    """Good and rejected messages of ``decode_with_reason`` in one pass, as a version under ``path``.

    Good ones become the parts ``split_by_kind`` makes; rejected ones keep their
    text and the reason in parts of the kind ``REJECTED``, one per reason.  Both
    are published together, so accepted and rejected rows add up to those sent.
    """
    bad = F.col("reason").isNotNull()
    events = dated_events(decoded, keep=("value", "reason"))
    good = [F.when(~bad, F.col(name)).alias(name) for name in OUTPUT_FIELDS]
    rows = events.select(
        *good,
        F.when(bad, F.col("value")).alias("value"),
        "reason",
        F.when(bad, REJECTED).otherwise(F.col("event_type")).alias("kind"),
        F.when(bad, F.col("reason")).otherwise(F.col("date")).alias("p_date"),
    )
    if rebalance:
        rows = rows.hint("rebalance", F.col("kind"), F.col("p_date"))
    return publish_split(rows, path)


def publish_split(rows: DataFrame, path: str, keep: int = KEEP) -> Version:
    """Rows with their ``kind`` and ``p_date`` as the next version under ``path``; a part per kind and date."""
    store = VersionedFolder(rows.sparkSession, path)
    base, folder = store.latest(), store.fresh()
    rows.write.partitionBy("kind", "p_date").json(store.path(folder))
    found = partition_folders(store.spark, path, folder, "kind", "p_date")
    published = store.publish(base, {f"{kind}/{date}": [at] for (kind, date), at in found.items()})
    store.expire(keep)
    return published


def finish_split(spark: SparkSession, path: str) -> None:
    """Move the kinds of a complete output that are not in their places yet."""
    recover(spark, path)
    for name in Directory(spark, path).children():
        if name.startswith(READY):
            ready = Directory(spark, join(path, name))
            for child in ready.children():
                target = Directory(spark, join(path, child.removeprefix("kind=")))
                ready.child(child).replace(target)
                spark.catalog.refreshByPath(target.path)
            ready.delete()
