"""SimHash near duplicates: fingerprints linked by multi-index hashing.

A fingerprint is cut in two segments of 32 bits.  Of two fingerprints that
differ in at most two bits, the high segments differ in at most one, or the low
ones are equal.  So each distinct fingerprint looks up the 33 values within one
bit of its high segment and its own low segment in tables of both segments, and
the complete distance of what it meets is verified.

A table place with more than ``CROWD`` fingerprints is not fetched.  Whoever
stands there or looks there gives its whole ball of one bit instead: two
fingerprints are within two bits exactly if their balls share a centre, and those
that share one are all linked, so each is linked with the least of at most 65.
Links of crowded places are found with a fixed number of rows a fingerprint.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.lookups import salted_join
from .common import pin, texts
from .components import contract

SHINGLE = 3
#: Fingerprints of one table place that are fetched one by one.
CROWD = 16
#: Text cut into words at once.
PART_BYTES = 1 << 18
SEED = 42


def word_parts(text: bytes, limit: int = PART_BYTES) -> Iterator[list[bytes]]:
    """The words of a text, A-Z lower-cased, cut at ``[\\x20\\x09-\\x0D]``, in parts of about ``limit`` bytes."""
    tail, low = b"", 0
    while low < len(text):
        part = tail + text[low : low + limit]
        low += limit
        words = part.lower().split()
        # The last word may go on in the next part.
        tail = b""
        if low < len(text) and words and not part[-1:].isspace():
            tail = words.pop()
        yield words
    if tail:
        yield [tail]


def votes(words: list[bytes], size: int) -> tuple[np.ndarray, int]:
    """How many shingles of the words have each of the 64 bits, and how many shingles there are."""
    hashes = [xxhash.xxh64_intdigest(b" ".join(s), SEED) for s in zip(*(words[i:] for i in range(size)))]
    bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.sum(0, dtype=np.int64), len(hashes)


def fingerprint(text: bytes, size: int = SHINGLE, limit: int = PART_BYTES) -> int:
    """64 bits, each set if more than half of the shingles' XXH64 values have it; 0 without words.

    A text of fewer than ``size`` words is one shingle.
    """
    total, n, before = np.zeros(64, np.int64), 0, []
    for part in word_parts(text, limit):
        words = before + part
        if len(words) >= size:
            ones, more = votes(words, size)
            total, n = total + ones, n + more
            words = words[len(words) - size + 1 :]
        before = words
    if not n and before:
        total, n = votes(before, len(before))
    return int(np.packbits(2 * total > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, size: int = SHINGLE) -> DataFrame:
    """(id, fp) of every row; ``fp`` holds the 64 bits as a signed number."""
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            data, offsets = texts(batch.column(1))
            found = [fingerprint(data[a:b].tobytes(), size) for a, b in zip(offsets[:-1], offsets[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.array(found, np.uint64).view(np.int64))], ["id", "fp"])

    return docs.mapInArrow(run, f"id {kind}, fp long")


def _ball(value: Column, bits: int) -> Column:
    """``value`` and the values that differ from it in one of the lowest ``bits`` bits."""
    flips = F.array(F.lit(0).cast("long"), *(F.lit(1 << i if i < 63 else -(1 << 63)).cast("long") for i in range(bits)))
    return F.transform(flips, value.bitwiseXOR)


def _probes(nodes: DataFrame) -> DataFrame:
    """(place, fp): the table places where each fingerprint looks.

    The high segment's places are numbers from 0, those of the low one negative.
    """
    high, low = F.shiftrightunsigned("fp", 32), -F.col("fp").bitwiseAND(0xFFFFFFFF) - 1
    return nodes.select(F.explode(F.concat(_ball(high, 32), F.array(low))).alias("place"), "fp")


def _table(nodes: DataFrame, crowd: int) -> DataFrame:
    """(place, n, members): the fingerprints at each place, null where they are more than ``crowd``."""
    high, low = F.shiftrightunsigned("fp", 32), -F.col("fp").bitwiseAND(0xFFFFFFFF) - 1
    stands = nodes.select(F.explode(F.array(high, low)).alias("place"), "fp")
    sizes = pin(stands.groupBy("place").agg(F.count("*").alias("n"), F.min("fp").alias("one")))
    # A crowded place is never gathered: only the small ones are joined again.
    shared = salted_join(stands, sizes.where(F.col("n").between(2, crowd)).select("place"), "place", "inner", ["fp"])
    gathered = shared.groupBy("place").agg(F.count("*").alias("n"), F.collect_list("fp").alias("members"))
    members = F.when(F.col("n") == 1, F.array("one"))
    return sizes.where(~F.col("n").between(2, crowd)).select("place", "n", members.alias("members")).unionByName(gathered)


def links(nodes: DataFrame, crowd: int = CROWD) -> DataFrame:
    """(a, b): pairs of the distinct fingerprints ``fp`` that connect all within two bits of each other.

    Every pair is within two bits; in crowded places some that others imply are left out.
    """
    met = salted_join(_probes(nodes), _table(nodes, crowd), "place", "inner", ["fp"])
    met = pin(met.where((F.col("n") > 1) | (F.get("members", F.lit(0)) != F.col("fp"))).select("fp", "members"))
    pairs = met.select(F.col("fp").alias("a"), F.explode("members").alias("b"))
    verified = pairs.where((F.col("a") != F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= 2))
    crowded = met.where(F.col("members").isNull()).select("fp").distinct()
    centres = crowded.select("fp", F.explode(_ball(F.col("fp"), 64)).alias("centre"))
    # At most 65 fingerprints share a centre.
    stars = centres.groupBy("centre").agg(F.min("fp").alias("b"), F.collect_list("fp").alias("members")).where(F.size("members") > 1)
    spokes = stars.select(F.explode("members").alias("a"), "b").where("a <> b")
    return verified.unionByName(spokes).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def simhash_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, crowd: int = CROWD) -> DataFrame:
    """For every row: ``id_col``, ``fingerprint`` (16 hex digits), ``component_id``, ``n_same`` (rows with the fingerprint).

    Rows are linked when their fingerprints differ in two bits or fewer;
    ``component_id`` is the smallest id that links lead to, directly or over
    others.  Null and empty texts have the fingerprint 0 and are linked like
    all others; a null id is no component id while there is another.  Repeated
    rows are rows of their own.  A text of any length is read in parts.  An
    empty table gives no row; other columns are ignored.
    """
    rows = pin(fingerprints(docs, id_col, text_col, size))
    nodes = pin(rows.groupBy("fp").agg(F.min("id").alias("least"), F.count("*").alias("n_same")))
    roots = contract(links(nodes.select("fp"), crowd)).withColumnRenamed("node", "fp")
    rooted = pin(nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp")))
    classes = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    settled = salted_join(rooted.select("fp", "root", "n_same"), classes, "root", "inner", ["fp"]).drop("root")
    # Rows with equal fingerprints may be many: they are spread by id.
    out = salted_join(rows, settled, "fp", "left", ["id"])
    return out.select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "n_same")
