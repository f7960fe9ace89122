"""Benchmark passages in documents, by winnowing.

Of every window of ``WINDOW`` words the smallest hash of its ``GRAM``-word runs
is kept, so a shared window has the same fingerprint on both sides.  The
benchmark's fingerprints are joined map-side, in blocks of bounded size, with
those of the documents; a hit is extended to the windows it stands for and each
is compared as a whole.  An item shorter than a window is one window of its own
length, with fingerprints of that length.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Grams, Words, sliding_min, texts, unused, with_columns, word_blocks

WINDOW = 10
GRAM = 5
#: Benchmark text sent to the executors at once; more goes in further blocks.
BLOCK_BYTES = 8 << 20
#: Document text taken at once.
TEXT_BYTES = 1 << 20


@dataclass
class Fingerprints:
    """Of all benchmark windows of one length: winnowed fingerprints, whole windows, and whose they are."""

    length: int
    gram: int
    prints: np.ndarray
    windows: np.ndarray
    item: np.ndarray


def winnow(words: Words, grams: Grams, length: int, gram: int) -> np.ndarray:
    """The fingerprint of the window from each word on: the smallest of its gram hashes."""
    return sliding_min(grams.all(gram), length - gram + 1) if len(words.hash) >= length else np.zeros(0, np.uint64)


def index(rows: list[str], window: int, gram: int) -> list[Fingerprints]:
    """Fingerprints of benchmark texts, by window length."""
    words = Words(*texts(pa.array(rows, pa.string())))
    grams, sizes = Grams(words.hash), np.diff(words.first)
    out = []
    for length in np.unique(np.minimum(sizes[sizes > 0], window)).tolist():
        own = min(gram, length)
        whole = sizes >= window if length == window else sizes == length
        at = np.flatnonzero(words.inside(length))
        at = at[whole[words.row[at]]]
        values = grams.at(at, length)
        order = np.argsort(values, kind="stable")
        prints = np.unique(winnow(words, grams, length, own)[at])
        out.append(Fingerprints(length, own, prints, values[order], words.row[at][order]))
    return out


def within(values: np.ndarray, sorted_values: np.ndarray) -> np.ndarray:
    at = np.searchsorted(sorted_values, values)
    at[at == len(sorted_values)] = 0
    return sorted_values[at] == values


def matches(words: Words, grams: Grams, known: Fingerprints) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the document windows that the benchmark has, and their hashes."""
    prints = winnow(words, grams, known.length, known.gram)
    if not len(prints) or not len(known.prints):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    # Neighbouring windows mostly share their fingerprint: each run is looked up once.
    first = np.concatenate(([0], np.flatnonzero(prints[1:] != prints[:-1]) + 1))
    hit = within(prints[first], known.prints)
    sizes = np.diff(np.append(first, len(prints)))
    starts = np.flatnonzero(np.repeat(hit, sizes))
    starts = starts[words.row[starts] == words.row[starts + known.length - 1]]
    values = grams.at(starts, known.length)
    same = within(values, known.windows)
    return starts[same], values[same]


def find_passages(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, gram: int = GRAM, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit``, ``hit_spans`` and ``hit_items``.

    Words are runs of ``[0-9a-z]`` and characters beyond ASCII, after A-Z are
    lower-cased.  ``hit_spans``: bounds of the maximal runs of hit words, as a
    flat list start, end, ...; ``hit_items``: ids, as sorted strings, of the
    items with a window in the text.  Items without words, a null text among
    them, hit nothing; a null item id is the empty string; rows with one item
    id are one item.  A null or empty document has no words.  Columns of these
    names are replaced, all others stay; repeated rows are scored alike; empty
    tables are valid on both sides.
    """
    items = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("id"), F.coalesce(F.col(item_text), F.lit("")).alias("text"))
    size = items.agg(F.sum(F.octet_length("text") + F.octet_length("id") + 16)).head()[0] or 0
    n_blocks = max(1, math.ceil(size / block_bytes))
    out = docs.drop("n_words", "hit_spans", "hit_items", "n_hit")
    new = "n_words long, hit_spans array<long>, hit_items array<string>"
    for block in range(n_blocks):
        # A block holds about block_bytes: a bounded list.
        own = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(n_blocks)) == block).collect()
        ids = sorted({r["id"] for r in own})
        place = {x: i for i, x in enumerate(ids)}
        item_of = np.array([place[r["id"]] for r in own], np.int64)
        sent = docs.sparkSession.sparkContext.broadcast((index([r["text"] for r in own], window, gram), item_of, ids))
        work = _pass(sent)
        out = with_columns(out, [text_col] if not block else [text_col, "hit_spans", "hit_items"], work, new)
    n_hit = F.aggregate(F.sequence(F.lit(0), F.size("hit_spans") - 2, F.lit(2)), F.lit(0).cast("long"), lambda t, i: t + F.get("hit_spans", i + 1) - F.get("hit_spans", i))
    return out.withColumn("n_hit", F.when(F.size("hit_spans") > 0, n_hit).otherwise(F.lit(0)).cast("long")).withColumn("hit_items", F.array_sort("hit_items"))


def _pass(sent):
    """One pass over the documents with one block of the benchmark; adds to what earlier passes found."""

    def work(column, old_spans=None, old_items=None):
        known, item_of, ids = sent.value
        n_words, all_spans, all_items = [], [], []
        for low, high, words in word_blocks(column, TEXT_BYTES):
            grams = Grams(words.hash)
            edge = np.zeros(len(words.hash) + 1, np.int64)
            pairs = [np.zeros((0, 2), np.int64)]
            for fingerprints in known:
                starts, values = matches(words, grams, fingerprints)
                np.add.at(edge, starts, 1)
                np.add.at(edge, starts + fingerprints.length, -1)
                # Each distinct window of a document leads to its items once.
                _, one = np.unique(np.stack([words.row[starts].astype(np.uint64), values]), axis=1, return_index=True)
                rows, values = words.row[starts][one], values[one]
                left, right = np.searchsorted(fingerprints.windows, values), np.searchsorted(fingerprints.windows, values, "right")
                take = np.arange((right - left).sum()) + np.repeat(left - np.concatenate(([0], np.cumsum(right - left)[:-1])), right - left) if len(left) else left
                pairs.append(np.stack([np.repeat(rows, right - left), item_of[fingerprints.item[take]]], axis=1))
            first = words.first
            n_words.append(np.diff(first))
            if old_spans is not None:
                for row in range(low, high):
                    old = np.array(old_spans[row].as_py() or [], np.int64) + first[row - low]
                    np.add.at(edge, old[::2], 1)
                    np.add.at(edge, old[1::2], -1)
            hit = np.concatenate(([0], np.cumsum(edge[:-1]) > 0, [0])).astype(np.int8)
            change = np.diff(hit)
            # A run that reaches over the end of a document is cut there.
            opens = np.flatnonzero((change[:-1] == 1) | (_at(first, len(change) - 1) & (hit[1:-1] == 1)))
            closes = np.flatnonzero((change[1:] == -1) | (_at(first, len(change))[1:] & (hit[1:-1] == 1))) + 1
            row_of = words.row[opens]
            cuts = np.searchsorted(row_of, np.arange(high - low + 1))
            flat = np.stack([opens - first[row_of], closes - first[row_of]], axis=1)
            pairs = np.unique(np.concatenate(pairs), axis=0)
            item_cuts = np.searchsorted(pairs[:, 0], np.arange(high - low + 1))
            for row in range(high - low):
                all_spans.append(flat[cuts[row] : cuts[row + 1]].ravel().tolist())
                found = {ids[i] for i in pairs[item_cuts[row] : item_cuts[row + 1], 1]}
                if old_items is not None:
                    found |= set(old_items[low + row].as_py() or [])
                all_items.append(sorted(found))
        n_words = np.concatenate(n_words) if n_words else np.zeros(0, np.int64)
        return [pa.array(n_words, pa.int64()), pa.array(all_spans, pa.list_(pa.int64())), pa.array(all_items, pa.list_(pa.string()))]

    return work


def _at(places: np.ndarray, size: int) -> np.ndarray:
    out = np.zeros(size, bool)
    out[places[places < size]] = True
    return out


def drop_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` without any benchmark window, with all their columns."""
    key = unused(docs, "source_text")
    names = {"n_words", "n_hit", "hit_spans", "hit_items"}
    keep = {c: unused(docs, f"own_{c}") for c in docs.columns if c.lower() in names}
    safe = docs.withColumnsRenamed(keep).withColumn(key, F.col(keep.get(text_col, text_col)))
    found = find_passages(safe, items, key, **options).where("n_hit = 0").drop(key, *names)
    return found.withColumnsRenamed({v: k for k, v in keep.items()}).select(*(F.col(f"`{c}`") for c in docs.columns))
