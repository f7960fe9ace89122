"""Repeated lines across documents, against levelled sorted runs of line hashes.

``LineRuns`` holds the keys seen so far as runs: tables bucketed and sorted by
key.  A batch of documents, later in id order than all before, is merge-joined
with the runs; the keys none of them has become a run of level 0.  When a level
has ``fanout`` runs they are compacted into one of the next level, so ``b``
batches leave at most ``fanout * log(b)`` runs and a key is rewritten at most
``log(b)`` times.  All runs together map a key to the smallest document that
holds it.
"""

from __future__ import annotations

import uuid

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import pin

#: Stripped at both ends of a line.
BLANK = b" \t\n\x0b\x0c\r"
MIN_CHARS = 10
BATCHES = 4
FANOUT = 2
#: The place of a null id: before all others.
NO_ID = -(1 << 63)
PAIRS = "h binary, doc_id long"


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """Digest of a line's key; None for a key shorter than ``min_chars`` code points."""
    key = line.strip(BLANK).lower()
    if len(key) < min_chars or (len(key) < 4 * min_chars and len(key.decode("utf-8", "surrogatepass")) < min_chars):
        return None
    return xxhash.xxh3_128_digest(key)


class LineRuns:
    """Sorted runs of (key, smallest document), levelled and compacted."""

    def __init__(self, spark: SparkSession, buckets: int | None = None, fanout: int = FANOUT):
        self.spark, self.fanout = spark, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []

    def _write(self, keys: DataFrame, level: int) -> None:
        name = f"line_run_{level}_{uuid.uuid4().hex}"
        # Buckets follow the shuffle by key, so each is one sorted file.
        keys.write.bucketBy(self.buckets, "h").sortBy("h").format("parquet").saveAsTable(name)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)

    def tables(self) -> list[str]:
        return [name for level in self.levels for name in level]

    def owners(self) -> DataFrame:
        """Every key seen, with the smallest document that holds it."""
        out = self.spark.createDataFrame([], "h binary, owner long")
        for name in self.tables():
            out = out.unionByName(self.spark.table(name))
        return out

    def add(self, pairs: DataFrame) -> None:
        """Merge-anti-join a batch of (key, document) pairs with the runs and add its new keys."""
        fresh = pairs.groupBy("h").agg(F.min("doc_id").alias("owner"))
        for name in self.tables():
            fresh = fresh.join(self.spark.table(name).select("h").hint("merge"), "h", "left_anti")
        self._write(fresh, 0)
        for level in range(len(self.levels) + 1):
            if level >= len(self.levels) or len(self.levels[level]) < self.fanout:
                break
            old, self.levels[level] = self.levels[level], []
            merged = self.spark.table(old[0])
            for name in old[1:]:
                merged = merged.unionByName(self.spark.table(name))
            self._write(merged.repartition(self.buckets, "h"), level + 1)
            for name in old:
                self.spark.sql(f"DROP TABLE {name}")

    def drop(self) -> None:
        for name in self.tables():
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.levels = []


def line_pairs(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """Distinct (h, doc_id) of every line long enough."""

    def split(batches):
        for batch in batches:
            keys, ids = [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py()
                found = {line_key(x, min_chars) for x in text.encode("utf-8", "surrogatepass").split(b"\n")} if text else set()
                found.discard(None)
                keys += found
                ids += [doc_id] * len(found)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(ids, pa.int64())], ["h", "doc_id"])

    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)), F.col(text_col))
    return rows.mapInArrow(split, PAIRS)


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, batches: int = BATCHES) -> DataFrame:
    """For every row: ``id_col``, ``n_lines``, ``n_dropped``, ``text`` (the lines that stay, joined by line feeds).

    A line's key is the line stripped of ASCII white space, with A-Z lower-cased.
    A key of ``min_chars`` code points or more keeps its lines in the smallest
    document that holds it only.  A null or empty text is one empty line.  A
    null id is the smallest; rows with one id are one document.  An empty table
    gives no row; other columns are ignored.
    """
    spark = docs.sparkSession
    pairs = line_pairs(docs, id_col, text_col, min_chars)
    bounds = docs.agg(F.percentile_approx(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)), [i / batches for i in range(1, batches)], 1000)).head()[0] if batches > 1 else []
    cuts = sorted(set(bounds or []))
    batch = F.lit(0)
    for cut in cuts:
        batch = batch + (F.col("doc_id") > F.lit(cut)).cast("int")
    pairs = pin(pairs.withColumn("batch", batch), "batch")
    runs = LineRuns(spark)
    for i in range(len(cuts) + 1):
        runs.add(pairs.where(F.col("batch") == i).select("h", "doc_id"))
    owners = pin(runs.owners())
    runs.drop()
    doomed = pairs.join(owners, "h").where(F.col("owner") < F.col("doc_id")).groupBy("doc_id").agg(F.collect_set("h").alias("doomed"))

    def keep(rows):
        for part in rows:
            kept, n_lines, n_dropped = [], [], []
            for text, gone in zip(part.column(1), part.column(2), strict=True):
                raw = (text.as_py() or "").encode("utf-8", "surrogatepass")
                lines = raw.split(b"\n")
                n_lines.append(len(lines))
                if gone.is_valid:
                    gone = set(gone.as_py())
                    lines = [x for x in lines if line_key(x, min_chars) not in gone]
                n_dropped.append(n_lines[-1] - len(lines))
                kept.append(b"\n".join(lines).decode("utf-8", "surrogatepass") if n_dropped[-1] else text.as_py() or "")
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(kept, pa.string())], ["id", "n_lines", "n_dropped", "text"])

    key = "doc_id"
    keyed = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias(key))
    joined = keyed.join(doomed, key, "left").select("id", "text", "doomed")
    kind = dict(docs.dtypes)[id_col]
    return joined.mapInArrow(keep, f"id {kind}, n_lines long, n_dropped long, text string").withColumnRenamed("id", id_col)
