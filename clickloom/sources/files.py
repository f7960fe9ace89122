"""File readers with declared schemas."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions.naming import label
from ..functions.payload import number_timestamps
from ..versions import VersionedFolder
from .paths import Directory, join


def read_weblog(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated log without header; an unreadable field becomes null."""
    return spark.read.schema(schemas.WEBLOG).csv(
        path, sep="\t", header=False, quote="", mode="PERMISSIVE"
    )


def read_segment(
    spark: SparkSession, path: str, field: str = "autousers", multi_line: bool = False
) -> DataFrame:
    """JSON document with one id array to a distinct ``uid`` column.

    ``multi_line`` reads a document that spans several lines.
    """
    document = spark.read.schema(schemas.segment(field)).json(path, multiLine=multi_line)
    ids = document.select(F.explode(field).alias("uid"))
    return ids.select(F.col("uid").try_cast("bigint").alias("uid")).na.drop().distinct()


def read_user_visits(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines, one user per line with the array of visits."""
    return spark.read.schema(schemas.USER_VISITS).json(path)


def read_split_events(spark: SparkSession, directory: str, kinds: Sequence[str]) -> DataFrame:
    """Whole lines of the split output of several kinds, with their ``p_date``."""
    sides = [_kind_lines(spark, directory, kind) for kind in kinds]
    return number_timestamps(reduce(DataFrame.unionByName, sides))


def read_rejected(spark: SparkSession, directory: str, kind: str = "_rejected") -> DataFrame:
    """``(value, reason)`` of the messages ``split_messages`` rejected."""
    store = VersionedFolder(spark, directory)
    version = store.latest()
    paths = store.paths(version, [n for n in version.parts if n.startswith(f"{kind}/")])
    schema = "value string, reason string"
    return spark.read.schema(schema).json(paths) if paths else spark.createDataFrame([], schema)


def _kind_lines(
    spark: SparkSession,
    directory: str,
    kind: str,
    dates: Sequence[str] | None = None,
    since: str | None = None,
) -> DataFrame:
    """Lines of one kind as text, with ``p_date``; days are chosen by directory or manifest."""
    schema = T.StructType([*schemas.SPLIT_EVENT.fields, T.StructField("p_date", T.StringType())])
    store = VersionedFolder(spark, directory)
    version = store.latest()
    if version.number:
        names = [
            name for name in version.parts
            if name.rpartition("/")[0] == kind and _chosen(name.rpartition("/")[2], dates, since)
        ]
        paths = store.paths(version, names)
        if not paths:
            return spark.createDataFrame([], schema)
        # A part is read by its own path, so its date comes from the lines.
        return spark.read.schema(schemas.SPLIT_EVENT).json(paths).withColumn("p_date", F.col("date"))
    lines = spark.read.schema(schema).json(kind_dir(spark, directory, kind))
    if dates is not None:
        lines = lines.where(F.col("p_date").isin(list(dates)))
    if since is not None:
        lines = lines.where(F.col("p_date") >= since)
    return lines


def _chosen(date: str, dates: Sequence[str] | None, since: str | None) -> bool:
    """Whether a part is read; one without a date only if all are."""
    if dates is None and since is None:
        return True
    return date.isdigit() and (dates is None or date in dates) and (since is None or date >= since)


def kind_dir(spark: SparkSession, directory: str, kind: str) -> str:
    """Where the split output has a kind: ``<kind>``, or ``kind=<kind>`` if that is there."""
    partition = join(directory, f"kind={kind}")
    return partition if Directory(spark, partition).exists() else join(directory, kind)


def kind_items(events: DataFrame, kind: str) -> DataFrame:
    """``(date, uid, item_id)`` of events of one kind, items named ``kind_item``."""
    return events.select("date", "uid", label(f"{kind}_", F.col("item_id")).alias("item_id"))


def read_events_dir(
    spark: SparkSession,
    directory: str,
    kind: str,
    dates: Sequence[str] | None = None,
    since: str | None = None,
) -> DataFrame:
    """Events of one kind as ``(date, uid, item_id)``, items named ``kind_item``.

    ``date`` is the text inside the rows.  ``dates`` and ``since`` (``yyyyMMdd``)
    choose by the date directories or the manifest, so other days are not read.  Rows without
    uid are kept: the newest date of a directory counts them, the matrix drops
    them.
    """
    return kind_items(_kind_lines(spark, directory, kind, dates, since), kind)
