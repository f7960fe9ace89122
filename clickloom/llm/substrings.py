"""Repeated substrings across documents, by suffix order of the places where they can be.

A window of ``size`` bytes has a minimizer: the smallest hash among its runs of
``MINIMIZER`` bytes.  Equal windows have equal minimizers, so

1. only windows whose minimizer occurs in two documents can repeat: documents
   send their minimizers to hash buckets, packed, and get the shared ones back;
2. neighbouring windows with one shared minimizer form a segment; segments go to
   the shard of their minimizer, so all equal windows meet in one shard;
3. a shard puts its distinct segments after one another and sorts their suffixes
   (``suffixes``): windows next to one another that share ``size`` bytes are
   equal, and each group gets the smallest document that holds it;
4. a document loses the bytes of its windows that a smaller one holds.

A copy of a whole document needs no search: all of it is in the smallest.  A
segment that is alone with its minimizer needs no sort: it equals itself only.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import suffixes
from .backoff import NO_ID, pack, postings, unpack
from .common import binaries, blocks, byte_spans, mix, prefix_hashes, release, sliding_min, texts, work_dir

SIZE = 50
MINIMIZER = 16
SEPARATOR = 0xFF  # no byte of UTF-8
BLOCK_BYTES = 1 << 20
#: Segments of whole minimizers that are sorted together; a minimizer with more is sorted alone.
SHARD_BYTES = 1 << 20
#: Windows of occurrences that are decided at once.
WINDOWS = 1 << 20


def segments(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of windows with one minimizer: its value, the row, and the bounds in ``data``."""
    run = min(MINIMIZER, size)
    n = len(data) - size + 1
    if n <= 0:
        empty = np.zeros(0, np.int64)
        return empty.astype(np.uint64), empty, empty, empty
    least = sliding_min(prefix_hashes(data, run), size - run + 1)
    # Windows that lie in one row.
    windows = np.maximum(np.diff(offsets) - size + 1, 0)
    row = np.repeat(np.arange(len(windows), dtype=np.int32), windows)
    starts = np.arange(len(row)) + np.repeat(offsets[:-1] - np.cumsum(windows) + windows, windows)
    value = least[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (value[1:] != value[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(starts))[: len(first)] - 1
    return value[first], row[first].astype(np.int64), starts[first], starts[last] + size


def _send(batches, size: int, buckets: int):
    """Distinct (minimizer, document) of blocks of documents, packed by bucket."""
    for batch in batches:
        ids = batch.column(0).to_numpy()
        data, offsets = texts(batch.column(1))
        for low, high in blocks(offsets, BLOCK_BYTES):
            at = offsets[low : high + 1]
            value, row, _, _ = segments(data[at[0] : at[-1]], at - at[0], size)
            # A minimizer is a minimum, mostly a small number: spread it first.
            bucket = ((mix(value) >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
            order = np.argsort(bucket.astype(np.uint32), kind="stable")
            cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
            packed = pack(np.diff(ids[low:high], prepend=0).view(np.uint64))
            full = [i for i in range(buckets) if cuts[i] < cuts[i + 1]]
            found = [postings(value[order[cuts[i] : cuts[i + 1]]], row[order[cuts[i] : cuts[i + 1]]]) for i in full]
            yield pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array(found, pa.binary()), pa.array([packed] * len(full), pa.binary())], ["bucket", "postings", "ids"])


def _shared(rows: list[tuple[bytes, bytes]]):
    """(id, minimizer) of the minimizers of one bucket that two documents have."""
    parts = []
    for packed, ids in rows:
        gaps, holders, docs, _ = unpack(packed, 4)
        keys, ids = np.cumsum(gaps, dtype=np.uint64), np.cumsum(unpack(ids, 1)[0].view(np.int64))
        parts.append((keys, holders.astype(np.int64), ids[docs]))
    distinct, inverse = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    low, high = np.full(len(distinct), np.iinfo(np.int64).max), np.full(len(distinct), np.iinfo(np.int64).min)
    places = np.split(inverse, np.cumsum([len(p[0]) for p in parts])[:-1])
    for (_, holders, ids), place in zip(parts, places, strict=True):
        first = np.cumsum(holders) - holders
        low[place] = np.minimum(low[place], np.minimum.reduceat(ids, first))
        high[place] = np.maximum(high[place], np.maximum.reduceat(ids, first))
    several = low < high
    for (keys, holders, ids), place in zip(parts, places, strict=True):
        use = np.repeat(several[place], holders)
        yield pa.RecordBatch.from_arrays([pa.array(ids[use]), pa.array(np.repeat(keys, holders)[use].view(np.int64))], ["id", "h"])


def _find_shared(batches):
    held, at = [], None
    for batch in batches:
        for bucket, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if held and bucket != at:
                yield from _shared(held)
                held = []
                release()
            at = bucket
            held.append(tuple(row))
    if held:
        yield from _shared(held)


def _cut(batches, size: int):
    """The segments with shared minimizers: each distinct one of a block once, with where it occurs."""
    for batch in batches:
        ids, contents, shared = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(3)
        data, offsets = texts(batch.column(2))
        for low, high in blocks(offsets, BLOCK_BYTES):
            at = offsets[low : high + 1] - offsets[low]
            own = data[offsets[low] : offsets[high]]
            value, row, start, end = segments(own, at, size)
            known = shared[low:high]
            of = np.repeat(np.arange(high - low), np.diff(known.offsets.to_numpy()))
            pairs = known.flatten().to_numpy().view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + of.astype(np.uint64)
            # A chance hit brings a segment too many, which does no harm.
            use = np.isin(value * np.uint64(0x9E3779B97F4A7C15) + row.astype(np.uint64), pairs)
            value, row, start, end = value[use], row[use], start[use], end[use]
            _, one, inverse = np.unique(byte_spans(own, start, end), return_index=True, return_inverse=True)
            order = np.argsort(inverse, kind="stable")
            cuts = pa.array(np.searchsorted(inverse[order], np.arange(len(one) + 1)).astype(np.int32))
            lists = [pa.ListArray.from_arrays(cuts, pa.array(x[order])) for x in (ids[low:high][row], contents[low:high][row], start - at[row])]
            yield pa.RecordBatch.from_arrays([pa.array(value[one].view(np.int64)), binaries(own, start[one], end[one]).cast(pa.binary()), *lists], ["h", "segment", "ids", "contents", "starts"])


def owners(values: np.ndarray, data: np.ndarray, low: np.ndarray, high: np.ndarray, least: np.ndarray, size: int) -> np.ndarray:
    """For distinct segments one after the other: the smallest document of each of their windows.

    ``values``: minimizers; ``low``, ``high``: bounds in ``data``; ``least``: the
    smallest document of each segment.
    """
    windows = high - low - size + 1
    out = np.repeat(least, windows)
    first = np.cumsum(windows) - windows
    _, group, members = np.unique(values, return_inverse=True, return_counts=True)
    order = np.argsort(group, kind="stable")
    order = order[members[group[order]] > 1]
    if not len(order):
        return out
    # Minimizers one after the other; a shard is cut where one of them ends.
    total = np.cumsum(high[order] - low[order] + 1)
    ends = np.append(np.flatnonzero(group[order][1:] != group[order][:-1]) + 1, len(order))
    begin = 0
    while begin < len(order):
        done = total[begin - 1] if begin else 0
        k = np.searchsorted(total[ends - 1], done + SHARD_BYTES, "right")
        end = int(ends[min(max(k - 1, np.searchsorted(ends, begin, "right")), len(ends) - 1)])
        _shard_owners(order[begin:end], data, low, high, least, windows, first, size, out)
        begin = end
        release()
    return out


def _shard_owners(own: np.ndarray, data: np.ndarray, low: np.ndarray, high: np.ndarray, least: np.ndarray, windows: np.ndarray, first: np.ndarray, size: int, out: np.ndarray) -> None:
    """Write the smallest documents of the windows of the segments ``own`` to ``out``."""
    lengths = high[own] - low[own]
    begin = np.cumsum(lengths + 1) - lengths - 1
    text = np.full(int(lengths.sum()) + len(own), SEPARATOR, np.uint8)
    at = np.arange(lengths.sum())
    before = np.cumsum(lengths) - lengths
    text[at + np.repeat(begin - before, lengths)] = data[at + np.repeat(low[own] - before, lengths)]
    segment_of = np.repeat(np.arange(len(own), dtype=np.int32), lengths + 1)
    for places, group in suffixes.repeated(text, size):
        segment = segment_of[places]
        inside = places - begin[segment]
        whole = inside < windows[own[segment]]
        segment, inside, group = own[segment[whole]], inside[whole], group[whole]
        if len(group):
            starts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
            smallest = np.minimum.reduceat(least[segment], starts)
            out[first[segment] + inside] = np.repeat(smallest, np.diff(np.append(starts, len(group))))


def _resolve(batches, size: int):
    """(id, content, start, end) of the bytes that documents of a shard lose."""
    rows = [b for b in batches if b.num_rows]
    if not rows:
        return
    table = pa.Table.from_batches(rows).combine_chunks()
    rows.clear()
    value = table["h"].to_numpy().view(np.uint64)
    column = table["segment"].combine_chunks().cast(pa.large_binary())
    data = np.frombuffer(column.buffers()[2], np.uint8)
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    lists = table["ids"].combine_chunks()
    of = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
    ids, contents, starts = (table[c].combine_chunks().flatten().to_numpy() for c in ("ids", "contents", "starts"))
    keys = [byte_spans(data[bounds[a] : bounds[b]], bounds[a:b] - bounds[a], bounds[a + 1 : b + 1] - bounds[a]) for a, b in blocks(bounds, BLOCK_BYTES)]
    _, one, inverse = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
    segment = inverse[of]
    least = np.full(len(one), np.iinfo(np.int64).max)
    np.minimum.at(least, segment, ids)
    low, high = bounds[:-1][one], bounds[1:][one]
    owner = owners(value[one], data, low, high, least, size)
    windows = high - low - size + 1
    first = np.cumsum(windows) - windows
    # Occurrences with about so many windows at once; one with more is taken alone.
    total = np.cumsum(windows[segment])
    cuts = np.unique(np.append(np.searchsorted(total, np.arange(0, int(total[-1]) + 1, WINDOWS), "right"), [0, len(segment)]))
    for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        own = segment[i:j]
        n = windows[own]
        before = np.cumsum(n) - n
        place = np.arange(n.sum()) - np.repeat(before, n)
        hit = owner[np.repeat(first[own], n) + place] < np.repeat(ids[i:j], n)
        edge = np.concatenate(([False], hit[:-1])) if len(hit) else hit
        opens = hit & (~edge | (place == 0))
        after = np.concatenate((hit[1:], [False])) if len(hit) else hit
        closes = hit & (~after | (place == np.repeat(n, n) - 1))
        opens, closes = np.flatnonzero(opens), np.flatnonzero(closes)
        which = i + np.searchsorted(before, opens, "right") - 1
        yield pa.RecordBatch.from_arrays([pa.array(ids[which]), pa.array(contents[which]), pa.array(starts[which] + place[opens]), pa.array(starts[which] + place[closes] + size)], ["id", "content", "start", "end"])


def _apply(batches, size: int):
    """What is left of each document."""
    for batch in batches:
        raw_ids, contents, column, gone, copy = (batch.column(i) for i in range(5))
        data, offsets = texts(column)
        n_removed, n_spans, kept = [], [], []
        for i, content in enumerate(contents.to_pylist()):
            own = data[offsets[i] : offsets[i + 1]]
            if copy[i].as_py() and len(own) >= size:
                spans, left = 1, b""
            elif not gone[i].is_valid:
                spans, left = 0, own.tobytes()
            else:
                edge = np.zeros(len(own) + 1, np.int64)
                found = gone[i].values.flatten()
                use = found[0].to_numpy() == content
                np.add.at(edge, found[1].to_numpy()[use], 1)
                np.add.at(edge, found[2].to_numpy()[use], -1)
                lost = np.cumsum(edge[:-1]) > 0
                spans = int((lost & ~np.concatenate(([False], lost[:-1]))).sum())
                left = own[~lost].tobytes()
            n_removed.append(len(own) - len(left))
            n_spans.append(spans)
            kept.append(left)
        yield pa.RecordBatch.from_arrays([raw_ids, pa.array(np.diff(offsets)), pa.array(n_removed, pa.int64()), pa.array(n_spans, pa.int64()), pa.array(kept, pa.binary())], ["id", "n_bytes", "n_removed", "n_spans", "kept"])


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE) -> DataFrame:
    """For every row: ``id_col``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept`` (the bytes that stay).

    A byte goes when a ``size``-byte string that covers it also starts in a
    document with a smaller id; strings are those of the texts as given, and
    never reach over a document's end.  ``n_spans`` counts the maximal removed
    runs.  What stays may end inside a character.  A null text is empty; a null
    id is the smallest; rows with one id are one document.  An empty table gives
    no row; other columns are ignored.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("digest", F.unhex(F.sha2("text", 256))).withColumn("content", F.xxhash64("digest"))
    path = work_dir(spark)
    name = f"repeats_{path.rpartition('-')[2]}"
    # Bucketed by id, so that no later join moves a text.
    rows.write.bucketBy(parts, "id").option("path", path).option("compression", "zstd").format("parquet").saveAsTable(name)
    table = spark.table(name)
    first = table.groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1").select("digest", "first")
    copies = table.select("id", "digest", "content").join(first, "digest").where("id > first").groupBy("id").agg(F.collect_set("content").alias("copies"))
    searched = table.join(copies, "id", "left").where("copies is null or not array_contains(copies, content)")
    sent = searched.select("id", "text").mapInArrow(lambda b: _send(b, size, parts), "bucket int, postings binary, ids binary")
    shared = sent.repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(_find_shared, "id long, h long")
    known = shared.groupBy("id").agg(F.collect_list("h").alias("shared"))
    found = searched.join(known, "id").select("id", "content", "text", "shared").mapInArrow(lambda b: _cut(b, size), "h long, segment binary, ids array<long>, contents array<long>, starts array<long>")
    lost = found.repartition(parts, "h").mapInArrow(lambda b: _resolve(b, size), "id long, content long, start long, end long")
    gone = lost.groupBy("id").agg(F.collect_list(F.struct("content", "start", "end")).alias("gone"))
    joined = table.join(gone, "id", "left").join(copies, "id", "left")
    kind = dict(docs.dtypes)[id_col]
    out = joined.select(F.nullif("id", F.lit(NO_ID)).cast(kind).alias("id"), "content", "text", "gone", F.coalesce(F.array_contains("copies", F.col("content")), F.lit(False)).alias("copy"))
    return out.mapInArrow(lambda b: _apply(b, size), f"id {kind}, n_bytes long, n_removed long, n_spans long, kept binary").withColumnRenamed("id", id_col)
