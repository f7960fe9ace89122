"""Ranked lexical search by an Aho-Corasick scan of the documents; no document index is built.

The terms of the items make an automaton whose patterns are guarded by a
boundary on both sides, so one pass over a text counts every term's occurrences
as a whole term.  Items go through in blocks of bounded size, one scan of all
documents each.  A scan leaves the documents' term counts, which are small, in
the shared folder; document frequencies and lengths come from them, and a second
pass maps each counted term to the items that hold it, adds up the scores in
64-bit integers and keeps each task's best documents of an item.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterator
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import pin, texts

#: Documents returned for an item.
TOP = 50
#: Item text in one automaton; an item with more is one alone.
BLOCK_BYTES = 1 << 20
#: Text scanned at once; a longer one is cut between terms.
SCAN_BYTES = 1 << 20
#: (term, item) pairs added up at once in a task.
PAIRS = 2_000_000

#: A-Z lower-cased, bytes outside terms a boundary.
GUARD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

_automata: dict[str, ahocorasick.Automaton] = {}


def terms_of(text: str | None) -> set[bytes]:
    return set((text or "").encode().translate(GUARD).split())


def guarded(text: bytes, limit: int = SCAN_BYTES) -> Iterator[str]:
    """The text in parts of about ``limit`` bytes cut between terms, each term with a boundary on both sides.

    Bytes are given as characters, so the automaton reads UTF-8 as it is.
    """
    low = 0
    while low < len(text):
        high = len(text)
        if high - low > limit:
            part = text[low : low + limit].translate(GUARD)
            cut = part.rfind(b" ")
            while cut < 0 and low + len(part) < len(text):
                part += text[low + len(part) : low + len(part) + limit].translate(GUARD)
                cut = part.find(b" ")
            high = low + cut if cut > 0 else low + 1 if cut == 0 else high
        yield f" {text[low:high].translate(GUARD).decode('latin-1')} "
        low = high


def automaton(terms: list[bytes]) -> ahocorasick.Automaton:
    built = ahocorasick.Automaton()
    for i, term in enumerate(terms):
        built.add_word(f" {term.decode('latin-1')} ", i)
    built.make_automaton()
    return built


def count_terms(text: bytes, built: ahocorasick.Automaton, limit: int = SCAN_BYTES) -> tuple[int, Counter]:
    """All terms of a text, and the occurrences of each term the automaton knows."""
    n, counts = 0, Counter()
    for part in guarded(text, limit):
        n += len(part.encode("latin-1").split())
        if built.kind == ahocorasick.AHOCORASICK:
            counts.update(map(itemgetter(1), built.iter(part)))
    return n, counts


def _scan(docs: DataFrame, terms: list[bytes]) -> DataFrame:
    """(id, n, term, tf): of every row the number of its terms, and the known terms with their counts."""
    sent, name = docs.sparkSession.sparkContext.broadcast(terms), uuid.uuid4().hex

    def run(batches):
        if name not in _automata:
            # A worker serves one block at a time.
            _automata.clear()
            _automata[name] = automaton(sent.value)
        built = _automata[name]
        for batch in batches:
            data, offsets = texts(batch.column(1))
            sizes, cuts, found, times = [], [0], [], []
            for a, b in zip(offsets[:-1], offsets[1:]):
                n, counts = count_terms(data[a:b].tobytes(), built)
                sizes.append(n)
                found.extend(counts.keys())
                times.extend(counts.values())
                cuts.append(len(found))
            cuts = pa.array(cuts, pa.int32())
            lists = [pa.ListArray.from_arrays(cuts, pa.array(flat, kind)) for flat, kind in ((found, pa.int32()), (times, pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), *lists], ["id", "n", "term", "tf"])

    return docs.mapInArrow(run, "id long, n long, term array<int>, tf array<long>")


class Best:
    """The best ``top`` documents of each item so far: by score, then the smaller id, a null id last."""

    def __init__(self, items: int, top: int):
        self.top, self.least = top, np.ones(items, np.int64)
        self.item, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))
        self.null = np.zeros(0, bool)

    def add(self, scores: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        """``scores``: a row per document and a column per item."""
        doc, item = np.nonzero(scores >= self.least)
        if not len(doc):
            return
        item = np.concatenate((self.item, item))
        score = np.concatenate((self.score, scores[doc, item[len(self.item) :]]))
        own, null = np.concatenate((self.id, ids[doc])), np.concatenate((self.null, null[doc]))
        order = np.lexsort((own, null, -score, item))
        place = np.arange(len(order)) - np.searchsorted(item[order], item[order])
        kept = order[place < self.top]
        self.item, self.score, self.id, self.null = item[kept], score[kept], own[kept], null[kept]
        last = order[place == self.top - 1]
        self.least[item[last]] = score[last]


def _ranked(scanned: DataFrame, weights: np.ndarray, holders: tuple[np.ndarray, np.ndarray], n_items: int, n_docs: int, n_terms: int, top: int) -> DataFrame:
    """(item, id, score): the best documents of each item of a block in each task."""
    sent = scanned.sparkSession.sparkContext.broadcast((weights, holders))

    def run(batches):
        weight, (first, holder) = sent.value
        best = Best(n_items, top)
        for batch in batches:
            ids = batch.column(0)
            null = np.asarray(ids.is_null())
            ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
            cuts = np.asarray(batch.column(2).offsets).astype(np.int64)
            term = batch.column(2).values.to_numpy(zero_copy_only=False)
            tf = batch.column(3).values.to_numpy(zero_copy_only=False)
            n = batch.column(1).to_numpy()
            m = np.repeat(50 + (50 * n * n_docs) // n_terms, np.diff(cuts))
            flat = slice(cuts[0], cuts[-1])
            term, tf = term[flat], tf[flat]
            value = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))
            pairs = np.concatenate(([0], np.cumsum(first[term + 1] - first[term])))
            low = 0
            while low < len(ids):
                # As many documents as the pairs and the score table allow, one at least.
                high = int(np.searchsorted(pairs[cuts - cuts[0]], pairs[cuts[low] - cuts[0]] + PAIRS, "right")) - 1
                high = min(len(ids), max(low + 1, min(high, low + max(1, PAIRS // n_items))))
                a, b = cuts[low] - cuts[0], cuts[high] - cuts[0]
                size = first[term[a:b] + 1] - first[term[a:b]]
                take = np.arange(pairs[b] - pairs[a]) + np.repeat(first[term[a:b]] - (pairs[a:b] - pairs[a]), size)
                doc = np.repeat(np.arange(high - low), np.diff(cuts[low : high + 1]))
                scores = np.zeros((high - low) * n_items, np.int64)
                np.add.at(scores, np.repeat(doc * n_items, size) + holder[take], np.repeat(value[a:b], size))
                best.add(scores.reshape(-1, n_items), ids[low:high], null[low:high])
                low = high
        yield pa.RecordBatch.from_arrays([pa.array(best.item, pa.int32()), pa.array(best.id, pa.int64(), mask=best.null), pa.array(best.score, pa.int64())], ["item", "id", "score"])

    return scanned.select("id", "n", "term", "tf").mapInArrow(run, "item int, id long, score long")


def item_blocks(items: DataFrame, limit: int) -> Iterator[list[tuple]]:
    """(id, terms) of the items in blocks of about ``limit`` bytes of terms; rows of one id are one item."""
    block, size, last = [], 0, None
    for row in items.orderBy("id").toLocalIterator():
        own = terms_of(row["text"])
        if last is not None and last[0] == row["id"]:
            last[1].update(own)
            continue
        if last is not None and last[1]:
            bytes_ = sum(map(len, last[1]))
            if block and size + bytes_ > limit:
                yield block
                block, size = [], 0
            block.append((last[0], last[1]))
            size += bytes_
        last = (row["id"], own)
    if last is not None and last[1]:
        block.append(last)
    if block:
        yield block


def search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", top: int = TOP, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """For every item its ``top`` best documents: ``item_id``, ``rank``, ``id_col``, ``score``.

    Terms are the runs of ``[0-9a-z]`` and characters beyond ASCII after A-Z
    are lower-cased.  A document's score adds, once for every term of the item,
    ``w * (1000000000 tf div (1000 tf + 20 m))`` with
    ``w = floor(1000 ln((2N + 2) / (2df + 1)))`` and ``m = 50 + 50 n N div L``:
    N documents have a term, L is the number of all terms, n that of the
    document.  Only scores above 0 are returned; equal scores are in the order
    of ids, a null id last.  Null and empty texts have no terms.  Rows of one
    item id are one item with the terms of all; a null item id is an id.
    Repeated documents are ranked one by one.  Ids are whole numbers, item ids
    of any type.  A text of any length is scanned in parts.  Empty tables give
    no row, other columns are ignored.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    items = items.select(F.col(item_id).alias("id"), F.col(item_text).alias("text"))
    kind = items.schema["id"].dataType.simpleString()
    parts = spark.createDataFrame([], f"{item_id} {kind}, id long, score long")
    for block in item_blocks(items, block_bytes):
        terms = sorted(set().union(*(own for _, own in block)))
        place = {t: i for i, t in enumerate(terms)}
        held = np.array([(place[t], i) for i, (_, own) in enumerate(block) for t in own], np.int64)
        held = held[np.lexsort((held[:, 1], held[:, 0]))]
        first = np.searchsorted(held[:, 0], np.arange(len(terms) + 1))
        scanned = pin(_scan(docs, terms))
        total = scanned.agg(F.count_if(F.col("n") > 0).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).head()
        if not total["terms"]:
            break
        # At most one row per term of the block.
        df = scanned.select(F.explode("term").alias("term")).groupBy("term").agg(F.count("*").alias("df")).collect()
        weights = np.zeros(len(terms), np.int64)
        for row in df:
            weights[row["term"]] = math.floor(1000 * math.log((2 * total["docs"] + 2) / (2 * row["df"] + 1)))
        found = _ranked(scanned, weights, (first, held[:, 1]), len(block), total["docs"], total["terms"], top)
        names = spark.createDataFrame([(i, name) for i, (name, _) in enumerate(block)], f"item int, {item_id} {kind}")
        parts = parts.unionByName(found.join(F.broadcast(names), "item").select(item_id, "id", "score"))
    best = (F.desc("score"), F.asc_nulls_last("id"))
    # The best of a part first, so no item gathers the rows of all tasks at once.
    salt = F.pmod(F.xxhash64("id"), F.lit(int(spark.conf.get("spark.sql.shuffle.partitions"))))
    for by in ([item_id, "salt"], [item_id]):
        parts = parts.withColumn("salt", salt).withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*best))).where(F.col("rank") <= top)
    return parts.select(item_id, "rank", F.col("id").alias(id_col), "score")
