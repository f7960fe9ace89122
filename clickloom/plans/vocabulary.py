"""The most frequent items from dated summaries, without reading old visits again.

For every date the store keeps all item counts and, beside them, a summary: the
``m`` most frequent items and ``least``, the count of the next one, which no item
outside the summary exceeds.  Summaries of many dates add up: an item's total is
at least what the summaries hold of it, and at most that plus ``least`` of the
dates that do not hold it.  Where these bounds cannot tell the first ``n`` items
from the rest, the summaries are widened; the items that may be among them are
then counted exactly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.features import top_items_of_counts
from ..versions import Parts, Version, VersionedFolder, partition_folders

#: Items of one date's first summary.
SUMMARY = 4000
COUNTS, TOPS = "counts", "tops"

_COUNTS = "item string, n bigint, date string"
_TOPS = _COUNTS + ", least bigint"


def _partition(df: DataFrame, store: VersionedFolder, part: str) -> Parts:
    """``df`` by date as fresh parts; the date stays in the rows."""
    folder = store.fresh()
    rows = df.withColumn("p_date", F.col("date")).hint("rebalance", F.col("p_date"))
    rows.write.partitionBy("p_date").parquet(store.path(folder))
    found = partition_folders(store.spark, store.root, folder, "p_date")
    return {f"{part}/{date}": [at] for (date,), at in found.items()}


def summaries(counts: DataFrame, m: int) -> DataFrame:
    """``(item, n, date, least)``: the first ``m`` items of each date; ``least`` is 0 where they are all.

    Parts of a date are cut down before they meet, so none gathers in one task.
    """
    order = (F.desc("n"), F.asc("item"))
    parts = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    top = counts.withColumn("_part", F.pmod(F.xxhash64("item"), F.lit(parts)))
    for by in (("date", "_part"), ("date",)):
        place = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
        top = top.withColumn("_place", place).where(F.col("_place") <= m + 1)
    beyond = F.max(F.when(F.col("_place") == m + 1, F.col("n"))).over(Window.partitionBy("date"))
    top = top.withColumn("least", F.coalesce(beyond, F.lit(0)))
    return top.where(F.col("_place") <= m).select("item", "n", "date", "least")


def add_dates(visits: DataFrame, root: str, m: int = SUMMARY) -> Version:
    """Count ``visits`` ``(date, item)`` and publish them; a date that comes again is replaced.

    Null, the text ``null`` and rows without a date do not count.  Other dates
    are neither read nor written.
    """
    spark = visits.sparkSession
    store = VersionedFolder(spark, root)
    base = store.latest()
    m = base.notes.get("m", m)
    kept = visits.where(F.col("date").isNotNull())
    counts = kept.groupBy("date", "item").agg(F.count_if(F.col("item") != "null").alias("n"))
    # The filter stands on the count, so a computed item is not computed twice.
    fresh = _partition(counts.where(F.col("n") > 0).select("item", "n", "date"), store, COUNTS)
    if not fresh:
        return base
    written = spark.read.schema(_COUNTS).parquet(*(store.path(f) for fs in fresh.values() for f in fs))
    tops = _partition(summaries(written, m), store, TOPS)
    return store.publish(base, base.parts | fresh | tops, {"m": m})


def _read(store: VersionedFolder, version: Version, part: str, schema: str, dates: Sequence[str]) -> DataFrame:
    paths = store.paths(version, [f"{part}/{d}" for d in dates])
    spark = store.spark
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def _candidates(tops: DataFrame, n: int) -> tuple[DataFrame, bool]:
    """Items that may be among the first ``n``, and whether no item outside the summaries can be."""
    unseen = tops.select("date", "least").distinct().agg(F.sum("least")).first()[0] or 0
    known = tops.groupBy("item").agg(
        F.sum("n").alias("low"), (F.lit(unseen) + F.sum(F.col("n") - F.col("least"))).alias("high")
    )
    first = known.orderBy(F.desc("low")).limit(n)
    bound, found = first.agg(F.min("low"), F.count("*")).first()
    if found < n:
        return known.select("item"), unseen == 0
    # An item that can only reach the bound may still win by its name.
    return known.where(F.col("high") >= bound).select("item"), unseen < bound


def top_items_by_date(
    spark: SparkSession, root: str, n: int = 1000, dates: Sequence[str] | None = None
) -> DataFrame:
    """``top_items`` of all dates of the store, or of some: ``(idx, item, n)``, ties and all.

    Summaries that are too short are widened fourfold and published, until the
    bounds prove the result; at the latest when they hold every item.
    """
    store = VersionedFolder(spark, root)
    version = store.latest()
    every = sorted(name.partition("/")[2] for name in version.parts if name.startswith(f"{COUNTS}/"))
    chosen = every if dates is None else [d for d in every if d in dates]
    while True:
        candidates, proven = _candidates(_read(store, version, TOPS, _TOPS, chosen), n)
        if proven:
            break
        m = version.notes["m"] * 4
        tops = _partition(summaries(_read(store, version, COUNTS, _COUNTS, every), m), store, TOPS)
        version = store.publish(version, version.parts | tops, {"m": m})
    counts = _read(store, version, COUNTS, _COUNTS, chosen)
    exact = counts.join(candidates, "item", "left_semi").groupBy("item").agg(F.sum("n").alias("n"))
    return top_items_of_counts(exact, "item", n)
