"""Per-user features: domain count vectors and time-of-visit counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clock import (
    EVENING_HOURS,
    TIME_FEATURES,
    WORK_HOURS,
    in_hours,
    utc_hour,
    utc_weekday,
)
from .lookups import BROADCAST_BYTES, local_bytes, salted_join


def top_items(df: DataFrame, item: str, n: int = 1000) -> DataFrame:
    """The ``n`` most frequent items with their count and alphabetical rank.

    Null and the text ``null`` do not count; a tie at the last place goes to
    the smaller item.  Returns ``(idx, item, n)``.
    """
    # A filter on the item would be moved below the aggregate and evaluate a
    # computed item twice per row; here null and "null" form groups of count 0.
    counted = (
        df.groupBy(item)
        .agg(F.count_if(F.col(item) != "null").alias("n"))
        .where(F.col("n") > 0)
    )
    return top_items_of_counts(counted, item, n)


def top_items_of_counts(counted: DataFrame, item: str, n: int) -> DataFrame:
    """``top_items`` of items that were counted already, each once."""
    first = counted.orderBy(F.col("n").desc(), F.col(item).asc()).limit(n)
    # At most n rows are left, so one sorted array of them is bounded.
    ordered = first.agg(F.array_sort(F.collect_list(F.struct(item, "n"))).alias("items"))
    return ordered.select(F.posexplode("items").alias("idx", "top")).select("idx", "top.*")


def vocabulary(df: DataFrame, item: str, n: int = 1000) -> list[str]:
    """``top_items`` as a sorted list on the driver, never longer than ``n``."""
    return [r[item] for r in top_items(df, item, n).orderBy("idx").collect()]


def count_vector(
    df: DataFrame,
    row: str,
    item: str,
    vocab: Sequence[str],
    name: str = "domain_features",
    element_type: str = "int",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Dense count array per row key; position = place of the item in ``vocab``.

    Items outside ``vocab`` are ignored, but their row key stays and gets
    zeros.  Counts are reduced per ``(row, position)`` first, so at most
    ``len(vocab)`` entries per row key are ever collected.
    """
    cells = _cells(df, row, item, vocab, broadcast_bytes)
    collected = _collected(cells, row, element_type)
    return collected.select(row, _dense("cells", F.lit(len(vocab)), element_type).alias(name))


def count_vector_sparse(
    df: DataFrame,
    row: str,
    item: str,
    vocab: Sequence[str],
    name: str = "domain_features",
    element_type: str = "int",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """The vectors of ``count_vector`` as ``struct<size, indices, values>``: the entries that are not 0.

    A row takes the room of the items it has, whatever the size of ``vocab``.
    Indices ascend; a row without items of ``vocab`` has empty arrays.
    """
    collected = _collected(_cells(df, row, item, vocab, broadcast_bytes), row, element_type)
    vector = F.struct(
        F.lit(len(vocab)).alias("size"),
        F.col("cells.idx").alias("indices"),
        F.col("cells.n").alias("values"),
    )
    return collected.select(row, vector.alias(name))


def to_dense(df: DataFrame, name: str = "domain_features") -> DataFrame:
    """Sparse vectors to arrays with one entry per position, for a reader that needs them."""
    element_type = df.schema[name].dataType["values"].dataType.elementType.simpleString()
    fields = [F.col(f"{name}.{f}").alias(f) for f in ("indices", "values")]
    cells = F.transform(
        F.arrays_zip(*fields), lambda c: F.struct(c["indices"].alias("idx"), c["values"].alias("n"))
    )
    dense = _dense("_cells", F.col(f"{name}.size"), element_type)
    return df.withColumn("_cells", cells).withColumn(name, dense).drop("_cells")


def _cells(
    df: DataFrame, row: str, item: str, vocab: Sequence[str], broadcast_bytes: int
) -> DataFrame:
    """``(row, idx, n)``: counts by place in ``vocab``, a null place for all other items."""
    lookup = df.sparkSession.createDataFrame(list(enumerate(vocab)), "idx int, _item string")
    lookup = lookup.withColumnRenamed("_item", item)
    rows = df.where(F.col(row).isNotNull()).select(row, item)
    if local_bytes(vocab) <= broadcast_bytes:
        placed = rows.join(F.broadcast(lookup), item, "left")
        return placed.groupBy(row, "idx").agg(F.count("*").alias("n"))
    pairs = rows.groupBy(row, item).agg(F.count("*").alias("n"))
    placed = salted_join(pairs, lookup, item, "left", spread=[row])
    return placed.groupBy(row, "idx").agg(F.sum("n").alias("n"))


def _collected(cells: DataFrame, row: str, element_type: str) -> DataFrame:
    """``(row, cells)``: the places and counts of each row, in order; never more than the vocabulary."""
    cell = F.struct(F.col("idx").alias("idx"), F.col("n").cast(element_type).alias("n"))
    return cells.groupBy(row).agg(
        F.array_sort(F.collect_list(F.when(F.col("idx").isNotNull(), cell))).alias("cells")
    )


def _dense(cells: str, size: Column, element_type: str) -> Column:
    end = F.struct(size.alias("idx"), F.lit(0).cast(element_type).alias("n"))
    # Each entry brings the zeros between it and its left neighbour; the end
    # marker brings the zeros after the last entry and is cut off again.
    closed = F.concat(F.col(cells), F.array(end))

    def run(entry, i):
        before = F.when(i == 0, F.lit(-1)).otherwise(
            F.try_element_at(F.col(cells), F.greatest(i, F.lit(1)))["idx"]
        )
        zeros = F.array_repeat(F.lit(0).cast(element_type), entry["idx"] - before - F.lit(1))
        return F.concat(zeros, F.array(entry["n"]))

    return F.slice(F.flatten(F.transform(closed, run)), F.lit(1), size)


def time_features(visits: DataFrame, ts: str = "timestamp", uid: str = "uid") -> DataFrame:
    """Visits per weekday and hour (UTC), and the work and evening fractions.

    The fractions divide by all visits of the user.
    """
    parts = visits.where(F.col(uid).isNotNull()).select(
        uid, utc_hour(F.col(ts)).alias("hour"), utc_weekday(F.col(ts)).alias("day")
    )
    counts = [
        F.expr(f"count_if({part} = {value}) AS {name}")
        for name, (part, value) in TIME_FEATURES.items()
    ]

    def fraction(span):
        return F.count_if(in_hours(F.col("hour"), span)) / F.count("*")

    return parts.groupBy(uid).agg(
        *counts,
        fraction(WORK_HOURS).alias("web_fraction_work_hours"),
        fraction(EVENING_HOURS).alias("web_fraction_evening_hours"),
    )


def feature_matrix(users_items: DataFrame, vectors: DataFrame, times: DataFrame) -> DataFrame:
    """Inner join of the three per-user tables on ``uid``."""
    return users_items.join(vectors, "uid", "inner").join(times, "uid", "inner")
