"""Stupid-backoff scores of documents, from word and word-pair counts of the whole corpus.

``S(w | v) = c(v w) / c(v)`` where the pair was seen ``MIN_COUNT`` times or more,
else ``ALPHA * c(w) / N``.  A document begins with a start mark, so each word has
a word before it.

Single rows of (n-gram, document) would shuffle many times the text.  A task
therefore sends each hash bucket one packed row per block of documents: sorted
n-grams with the documents that hold them and how often.  A bucket owns all
words of some hash range.  It gets each word's count and each pair twice, as
a continuation of its first word and as a predecessor of its second, so that
``c(v)``, ``c(w)`` and ``c(v w)`` meet where they are needed: the bucket counts,
joins counts and postings, and gives the partial sums of each block's documents,
packed again.  They are added per block, then per document.

Words are told apart by all 64 bits of their hash.  A row lists the hashes of its
words and of their neighbours once, and its pairs are places in these two lists;
the bucket numbers the hashes of all rows and counts pairs of numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, mix, pin, release, word_blocks

ALPHA = 0.4
#: Pairs seen fewer times are as unseen, so that a text is not its own evidence.
MIN_COUNT = 2
START = np.uint64(0x6A09E667F3BCC909)
NO_ID = -(1 << 63)
# Packed parts of a row: words and neighbours, pairs by first word, pairs by second word.
KINDS = ("words", "after", "before")


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays byte plane by byte plane, compressed."""
    planes = [np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes() for x in arrays]
    sizes = np.array([v for x in arrays for v in (len(x), x.itemsize)], np.int64)
    return sizes.tobytes() + zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def unpack(content: bytes, n: int) -> list[np.ndarray]:
    sizes = np.frombuffer(content, np.int64, 2 * n).reshape(n, 2)
    flat = np.frombuffer(zstandard.ZstdDecompressor().decompress(content[16 * n :]), np.uint8)
    out, at = [], 0
    for length, width in sizes.tolist():
        planes = flat[at : at + length * width].reshape(width, length)
        out.append(np.ascontiguousarray(planes.T).view(f"u{width}").ravel())
        at += length * width
    return out


def postings(keys: np.ndarray, rows: np.ndarray) -> bytes:
    """Sorted distinct keys as differences, documents per key, documents, and times in each."""
    order = np.argsort(keys, kind="stable")
    keys, rows = keys[order], rows[order]
    new_key = np.concatenate(([True], keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, bool)
    new = new_key.copy()
    new[1:] |= rows[1:] != rows[:-1]
    at, first = np.flatnonzero(new), np.flatnonzero(new_key)
    times = np.diff(np.append(at, len(keys))).astype(np.uint32)
    holders = np.diff(np.append(np.searchsorted(at, first), len(at))).astype(np.uint32)
    return pack(np.diff(keys[first], prepend=np.uint64(0)), holders, rows[at].astype(np.uint32), times)


def block_rows(words: Words, ids: np.ndarray, buckets: int) -> Iterator[tuple[int, list[bytes]]]:
    """(bucket, packed parts and ids) of a block of documents."""
    n, full = len(words.hash), np.flatnonzero(np.diff(words.first) > 0)
    if not n:
        return
    hashes = np.concatenate([words.hash, np.full(len(full), START)])
    distinct, place = np.unique(mix(hashes), return_inverse=True)
    word, mark = place[:n], place[-1]
    before = np.concatenate(([mark], word[:-1]))
    before[words.first[:-1][full]] = mark
    # The upper bits of the owner word's hash give the bucket, so a bucket's words are neighbours in ``distinct``.
    half = np.uint64(32)
    bucket_of = (((distinct >> half) * np.uint64(buckets)) >> half).astype(np.uint16 if buckets < 1 << 16 else np.uint32)
    counts = np.bincount(place, minlength=len(distinct)).astype(np.uint32)
    ends = np.searchsorted(bucket_of, np.arange(buckets + 1))
    parts = []
    for own, other in ((before, word), (word, before)):
        bucket = bucket_of[own]
        order = np.argsort(bucket, kind="stable")
        parts.append((own[order], other[order], words.row[order], np.searchsorted(bucket[order], np.arange(buckets + 1))))
    packed = pack(np.diff(ids, prepend=0).astype(np.int64).view(np.uint64))
    for i in range(buckets):
        low, high = ends[i], ends[i + 1]
        if low == high:
            continue
        mine = [(own[cuts[i] : cuts[i + 1]], other[cuts[i] : cuts[i + 1]], row[cuts[i] : cuts[i + 1]]) for own, other, row, cuts in parts]
        names, at = np.unique(np.concatenate([other for _, other, _ in mine]), return_inverse=True)
        at = np.split(at, [len(mine[0][0])])
        lists = pack(np.diff(distinct[low:high], prepend=np.uint64(0)), counts[low:high], np.diff(distinct[names], prepend=np.uint64(0)))
        yield i, [lists, *(postings(((own - low) * len(names) + x).astype(np.uint64), row) for (own, _, row), x in zip(mine, at, strict=True)), packed]


def numbered(lists: list[np.ndarray]) -> tuple[int, list[np.ndarray]]:
    """How many distinct values the lists have, and the number of each value among these."""
    distinct, inverse = np.unique(np.concatenate(lists), return_inverse=True)
    return len(distinct), np.split(inverse.astype(np.uint64), np.cumsum([len(x) for x in lists])[:-1])


def totals(lists: list[list[np.ndarray]], own: list[np.ndarray], names: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Owner words of the distinct pairs of all blocks, the pairs' counts, and each block's places among them."""
    keys = []
    for x, words, others in zip(lists, own, names, strict=True):
        first, second = np.divmod(np.cumsum(x[0]), np.uint64(len(others)))
        keys.append(words[first] << np.uint64(32) | others[second])
    counts = [np.add.reduceat(x[3].astype(np.int64), np.cumsum(x[1], dtype=np.int64) - x[1].astype(np.int64)) if len(x[1]) else np.zeros(0, np.int64) for x in lists]
    distinct, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    sums = np.bincount(inverse, np.concatenate(counts), len(distinct)).astype(np.int64)
    return distinct >> np.uint64(32), sums, np.split(inverse, np.cumsum([len(k) for k in keys])[:-1])


def added(rows: np.ndarray, weights: np.ndarray, size: int) -> np.ndarray:
    """Sum of the weights of each row, also of no rows at all."""
    return np.bincount(rows, weights, size).astype(np.float64)


def bucket_sums(blocks: list[list[bytes]], min_count: int) -> Iterator[pa.RecordBatch]:
    """Each document's share of words, backed-off words and log-scores in one bucket, packed by block."""
    heads = [unpack(row[0], 3) for row in blocks]
    lists = [[unpack(x, 4) for x in row[1:3]] for row in blocks]
    size, own = numbered([np.cumsum(words) for words, _, _ in heads])
    c_word = np.bincount(np.concatenate(own).astype(np.int64), np.concatenate([count for _, count, _ in heads]), size)
    _, names = numbered([np.cumsum(others) for _, _, others in heads])
    (after, c_after, at_after), (before, c_before, at_before) = (totals([x[i] for x in lists], own, names) for i in range(2))
    seen = c_after >= min_count
    gain = np.where(seen, np.log(c_after) - np.log(c_word[after]), 0.0)
    back = c_before < min_count
    fall = np.where(back, np.log(c_word[before]), 0.0)
    del heads, own, names
    release()
    for i, row in enumerate(blocks):
        ids = np.cumsum(unpack(row[3], 1)[0].view(np.int64))
        (_, n_after, docs_after, times_after), (_, n_before, docs_before, times_before) = lists[i]
        place, size = np.repeat(at_after[i], n_after), len(ids)
        n = added(docs_after, times_after, size)
        total = added(docs_after, gain[place] * times_after, size)
        place = np.repeat(at_before[i], n_before)
        total += added(docs_before, fall[place] * times_before, size)
        backed = added(docs_before, back[place] * times_before, size)
        sums = pack(n.astype(np.uint32), backed.astype(np.uint32), total)
        # Blocks of the same ids may share a name: their sums would be added in the end anyway.
        name = xxhash.xxh3_128_digest(row[3])
        yield pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in (name, row[3], sums)], ["block", "ids", "sums"])


def add_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of each document of a block over all buckets, from rows sorted by block."""
    at, ids, total = None, None, None

    def done():
        return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total[0].astype(np.int64)), pa.array(total[1].astype(np.int64)), pa.array(total[2])], ["id", "n", "backed", "total"])

    for batch in batches:
        for block, packed, sums in zip(*batch.columns, strict=True):
            n, backed, score = unpack(sums.as_py(), 3)
            new = [n.astype(np.float64), backed.astype(np.float64), score.view(np.float64)]
            if block.as_py() == at:
                total = [a + b for a, b in zip(total, new, strict=True)]
                continue
            if at is not None:
                yield done()
            at, ids, total = block.as_py(), np.cumsum(unpack(packed.as_py(), 1)[0].view(np.int64)), new
    if at is not None:
        yield done()


def backoff_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", alpha: float = ALPHA, min_count: int = MIN_COUNT) -> DataFrame:
    """For every id: ``id_col``, ``n_words``, ``n_backoff``, ``log_score`` (natural), ``mean_log_score`` per word.

    Counts are of all documents.  Words are those of ``common.Words``; ids are
    integers.  Rows with one id, or without an id, are one document.  A document
    without words (a null or empty text) has log score 0 and no mean.  An empty
    table gives no row; other columns are ignored.
    """
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    def send(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for low, high, words in word_blocks(batch.column(1)):
                found = list(block_rows(words, ids[low:high], partitions))
                yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in found], pa.int32()), *(pa.array([x[k] for _, x in found], pa.binary()) for k in range(4))], ["bucket", *KINDS, "ids"])

    def score(batches):
        held = [[c.as_py() for c in row] for batch in batches for row in zip(*batch.columns[1:], strict=True)]
        if held:
            yield from bucket_sums(held, min_count)

    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)), F.col(text_col))
    packed = rows.mapInArrow(send, "bucket int, words binary, after binary, before binary, ids binary")
    # A bucket is a partition.
    parts = packed.repartitionById(partitions, "bucket").mapInArrow(score, "block binary, ids binary, sums binary")
    added = parts.repartition(partitions, "block").sortWithinPartitions("block").mapInArrow(add_blocks, "id long, n long, backed long, total double")
    sums = added.groupBy("id").agg(F.sum("n").alias("n_words"), F.sum("backed").alias("n_backoff"), F.sum("total").alias("total"))
    # The number of words is only known at the end; it enters once for each backed-off word.
    sums = pin(sums)
    words = sums.agg(F.sum("n_words")).head()[0] or 1
    kind = dict(docs.dtypes)[id_col]
    zero = F.lit(0).cast("long")
    n, backed = F.coalesce("n_words", zero), F.coalesce("n_backoff", zero)
    log_score = F.coalesce(F.col("total"), F.lit(0.0)) + backed * float(np.log(alpha) - np.log(words))
    every = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id")).distinct()
    return every.join(sums, "id", "left").select(
        F.nullif("id", F.lit(NO_ID)).cast(kind).alias(id_col), n.alias("n_words"), backed.alias("n_backoff"),
        log_score.alias("log_score"), F.try_divide(log_score, n).alias("mean_log_score"),
    )
