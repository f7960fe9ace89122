"""Joins of a large fact side with a lookup side that has unique keys.

A lookup is broadcast only after its size was measured.  Above the bound the
callers first shrink the facts to counts and then use ``salted_join``, which
spreads the keys measured as hot over several tasks and no others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.naming import quoted

BROADCAST_BYTES = 64 * 1024 * 1024

# Fixed row overhead assumed for the hash table of a broadcast.
_ROW_BYTES = 32
# A key is hot when it holds this part of all fact rows, so at most 100 are.
HOT_SHARE = 0.01


def fits_broadcast(lookup: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Measure ``lookup`` with one distributed aggregate and compare to the bound."""
    text = [
        F.coalesce(F.octet_length(F.col(quoted(f.name))), F.lit(0))
        for f in lookup.schema.fields
        if isinstance(f.dataType, (T.StringType, T.BinaryType))
    ]
    fixed = F.lit(_ROW_BYTES + 8 * len(lookup.columns))
    width = sum(text, fixed)
    size = lookup.agg(F.sum(width.cast("bigint")).alias("size")).first()["size"] or 0
    return size <= max_bytes


def local_bytes(keys: Sequence[str]) -> int:
    """The same measure for a lookup of an index and a key that is a driver list."""
    return sum(_ROW_BYTES + 16 + len(key.encode()) for key in keys)


def default_salts(spark: SparkSession) -> int:
    """Parts per key: an eighth of the shuffle partitions, from 8 to 256."""
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return min(256, max(8, partitions // 8))


def hot_keys(facts: DataFrame, key: str, share: float = HOT_SHARE) -> list:
    """Keys that hold ``share`` of all rows or more: at most ``1 / share`` values.

    A null key matches nothing and is not among them.
    """
    counted = facts.groupBy(key).agg(F.count("*").alias("_n"))
    # The largest 1 / share groups hold every key that can reach the share.
    largest = counted.orderBy(F.desc("_n")).limit(int(1 / share)).collect()
    total = facts.count() if largest else 0
    return [r[0] for r in largest if r[0] is not None and r[1] >= share * total]


def parts_of(lookup: DataFrame, key: str, hot: Sequence, salts: int) -> DataFrame:
    """The lookup rows of hot keys once per part, all others once."""
    one = F.array(F.lit(0))
    every = F.sequence(F.lit(0), F.lit(salts - 1))
    parts = F.when(F.col(quoted(key)).isin(list(hot)), every).otherwise(one) if hot else one
    return lookup.withColumn("_part", F.explode(parts))


def salted_join(
    facts: DataFrame,
    lookup: DataFrame,
    key: str,
    how: str,
    spread: Sequence[str],
    salts: int | None = None,
    hot: Sequence | None = None,
) -> DataFrame:
    """Equi-join on ``key`` that splits each hot key of ``facts`` into ``salts`` parts.

    Hot keys are counted first, unless ``hot`` lists them.  The part is a hash of the ``spread`` columns,
    so it is the same when a lost task runs again.  ``lookup`` must be unique by
    ``key``; only its rows of hot keys are repeated.  Rows with a null key are
    spread too.  Adaptive execution can still split a part that is too large.
    """
    salts = salts or default_salts(facts.sparkSession)
    hot = hot_keys(facts, key) if hot is None else hot
    column = F.col(quoted(key))
    split = column.isNull() | column.isin(hot) if hot else column.isNull()
    part = F.pmod(F.xxhash64(*[F.col(quoted(c)) for c in spread]), F.lit(salts)).cast("int")
    return (
        facts.withColumn("_part", F.when(split, part).otherwise(F.lit(0)))
        .join(parts_of(lookup, key, hot, salts), [key, "_part"], how)
        .drop("_part")
    )
