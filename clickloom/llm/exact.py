"""Exact duplicates: frequent digests are found first and removed map-side, the rest is shuffled.

A Misra-Gries summary of each partition (at most ``2 / share`` counters) is
merged by summing.  Over ``n`` rows the sums fall short of the true counts by
less than ``n * share / 2``, so every digest held by ``share`` of all rows is
among the candidates, and at most ``2 / share`` digests are.  The candidates
are counted exactly; the winners, again at most ``1 / share``, are broadcast and
settle their rows without a shuffle.  All other digests hold less than
``share`` of the rows each and are grouped and joined in the ordinary way.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pin, unused

#: A digest is frequent when it holds this part of all rows.
SHARE = 0.001


def misra_gries(keys: Iterator[pa.Array], counters: int) -> dict:
    """Counts of at most ``counters`` keys, each short by at most ``rows / (counters + 1)``."""
    kept: dict = {}
    for column in keys:
        for item in pc.value_counts(column).to_pylist():
            kept[item["values"]] = kept.get(item["values"], 0) + item["counts"]
        if len(kept) > counters:
            less = sorted(kept.values(), reverse=True)[counters]
            kept = {k: v - less for k, v in kept.items() if v > less}
    return kept


def frequent(df: DataFrame, key: str, share: float = SHARE) -> DataFrame:
    """The values of ``key`` that at least ``share`` of all rows hold: at most ``1 / share`` rows.

    Columns ``key`` and ``rows`` (the exact count).  An empty table has none.
    """
    counters = max(1, int(2 / share))

    def summarise(batches):
        kept = misra_gries((b.column(0) for b in batches), counters)
        yield pa.RecordBatch.from_arrays([pa.array(list(kept), pa.string()), pa.array(list(kept.values()), pa.int64())], ["key", "rows"])

    total = df.count()
    summary = df.select(F.col(key)).mapInArrow(summarise, "key string, rows long")
    candidates = (
        summary.groupBy("key").agg(F.sum("rows").alias("rows"))
        .where(F.col("rows") >= max(1, total * (share - 1 / (counters + 1)))).select("key")
    )
    exact = df.select(F.col(key).alias("key")).join(F.broadcast(candidates), "key").groupBy("key").agg(F.count("*").alias("rows"))
    return exact.where(F.col("rows") >= max(2, total * share)).select(F.col("key").alias(key), "rows")


def exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", share: float = SHARE) -> DataFrame:
    """For every row: ``id_col``, ``digest`` (SHA-256 of the text, hex), ``group_size``, ``keep_id``, ``kept``.

    Of rows with equal texts the largest id stays.  A null text is the empty
    text.  A null id is smaller than all others.  Repeated rows count one by
    one; all rows of the staying id are marked ``kept`` (``drop_copies`` leaves
    one).  An empty table gives no row; other columns are ignored.
    """
    digests = pin(docs.select(F.col(id_col).alias("id"), F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256).alias("digest")))
    winners = frequent(digests, "digest", share).select("digest")
    total = (F.count("*").alias("group_size"), F.max("id").alias("keep_id"))
    hot = pin(digests.join(F.broadcast(winners), "digest").groupBy("digest").agg(*total))
    settled = digests.join(F.broadcast(hot), "digest")
    rest = digests.join(F.broadcast(hot.select("digest")), "digest", "left_anti")
    shuffled = rest.join(rest.groupBy("digest").agg(*total), "digest")
    out = settled.unionByName(shuffled)
    return out.select(F.col("id").alias(id_col), "digest", "group_size", "keep_id", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", share: float = SHARE) -> DataFrame:
    """The rows of ``docs`` that stay, one per distinct text, with all their columns."""
    key = unused(docs, "row_key")

    def row_key(digest, doc_id):
        return F.concat_ws(":", digest, doc_id.cast("string"))

    stays = exact_copies(docs, id_col, text_col, share).where("kept").select(row_key(F.col("digest"), F.col(id_col)).alias(key))
    keyed = docs.withColumn(key, row_key(F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256), F.col(id_col)))
    return keyed.join(stays, key, "left_semi").dropDuplicates([key]).drop(key)
