"""Phrase collocations by marginalising the longest windows.

Every word begins one window: itself and the words that follow it in its piece,
padded to the longest phrase length.  Only these windows are counted.  A phrase's
count is the sum over the windows that begin with it, which ROLLUP gives for all
lengths at once, so shorter n-grams are never made from the text.

A window is cut behind its longest prefix that can be a frequent phrase.  To tell
that, hashes are counted first: of words, of pairs of words met often enough, and
of longer prefixes of such pairs.  Those met ``min_count`` times are kept as bit
maps of fixed size.  Rare phrases that share a hash or a bit with frequent ones
only leave windows longer than need be; the counts of all phrases met
``min_count`` times are exact.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.lookups import salted_join
from .common import pin, texts, with_columns

MIN_COUNT = 30
MAX_WORDS = 4
TOP = 2000
#: Bits of one bit map: 2**25 are 4 MB.
SLOTS = 1 << 25
#: Hashes that are counted: a power of two, so that bits are hashes cut off.
HASHES = 1 << 40

# What each byte of a text becomes; bytes of characters beyond ASCII stay.
_FOLDED = np.arange(256, dtype=np.uint8)
_FOLDED[ord("A") : ord("Z") + 1] += 32
_FOLDED[ord("\t")] = ord(" ")
_FOLDED[list(b".,;:!?\n\x0b\x0c\r")] = ord("\n")


def _plain(column: pa.Array) -> list[pa.Array]:
    """The texts in lower case (A-Z), with a line break at each end of a piece and blanks for tabs; null is empty."""
    data, offsets = texts(column)
    return [pa.StringArray.from_buffers(len(column), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(_FOLDED[data]))]


def piece_words(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """(lang, w): the words of every piece of text, as an array."""
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang")
    plain = with_columns(docs.select(lang, F.col(text_col).alias("text")), ["text"], _plain, "text string")
    pieces = plain.select("lang", F.explode(F.split("text", "\n")).alias("piece"))
    return pieces.select("lang", F.array_remove(F.split("piece", " "), "").alias("w"))


def windows(words: DataFrame, size: int) -> DataFrame:
    """(lang, w1, ..., w<size>): a row for every word, with the words after it; beyond the piece they are null."""
    ahead = [F.slice("w", i + 1, F.size("w")).alias(f"w{i + 1}") if i else F.col("w").alias("w1") for i in range(size)]
    return words.select("lang", F.inline(F.arrays_zip(*ahead)).alias(*(f"w{i + 1}" for i in range(size))))


def _hash(*words: str) -> Column:
    return F.xxhash64("lang", *words).bitwiseAND(HASHES - 1)


def slot_map(df: DataFrame, slots: int, min_count: int) -> DataFrame:
    """One row ``bits``: a bit for every value of ``hash`` that ``min_count`` rows have, in words of 64 bits."""
    often = df.groupBy("hash").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)
    often = often.select(F.col("hash").bitwiseAND(slots - 1).alias("slot"))
    bit = F.expr("shiftleft(1L, cast(slot % 64 AS int))")
    words = often.groupBy(F.floor(F.col("slot") / 64).alias("at")).agg(F.bit_or(bit).alias("bits"))
    # All places, at most slots / 64, so the array is dense.
    every = df.sparkSession.range(slots // 64).select(F.col("id").alias("at"), F.lit(0).cast("long").alias("bits"))
    full = words.unionByName(every).groupBy("at").agg(F.bit_or("bits").alias("bits"))
    return pin(full.agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "bits"))), lambda x: x["bits"]).alias("bits")))


def in_map(bits: DataFrame, slots: int, hashed: Column) -> Column:
    """Whether the bit of a hash is set."""
    slot = hashed.bitwiseAND(slots - 1)
    return F.getbit(F.get(bits.scalar(), F.shiftright(slot, 6).cast("int")), slot.bitwiseAND(63).cast("int")) == 1


def _set(bits: DataFrame, slots: int, *words: str) -> Column:
    return in_map(bits, slots, _hash(*words))


def frequent_phrases(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, slots: int = SLOTS) -> DataFrame:
    """(lang, words, f): every phrase of at most ``max_words`` words met ``min_count`` times; no words: all words of the language."""
    words = piece_words(docs, text_col, lang_col)
    known = slot_map(windows(words, 1).select(_hash("w1").alias("hash")), slots, min_count)

    def may(n: int) -> Column:
        return _set(known, slots, f"w{n}")

    two = windows(words, 2).where(F.col("w2").isNotNull()).where(may(1) & may(2))
    pairs = slot_map(two.select(_hash("w1", "w2").alias("hash")), slots, min_count)
    names = [f"w{n}" for n in range(1, max_words + 1)]
    whole = windows(words, max_words)
    length = F.when(~may(1), 0)
    if max_words > 1:
        length = length.when(F.col("w2").isNull() | ~_set(pairs, slots, "w1", "w2"), 1)
    if max_words > 2:
        # Most rows go at their first two pairs, before anything else is looked up.
        chain = whole.where(_set(pairs, slots, "w1", "w2")).where(F.col("w3").isNotNull()).where(_set(pairs, slots, "w2", "w3"))
        hashes, linked = [_hash(*names[:3])], F.lit(True)
        for n in range(4, max_words + 1):
            linked = linked & F.col(names[n - 1]).isNotNull() & _set(pairs, slots, *names[n - 2 : n])
            hashes.append(F.when(linked, _hash(*names[:n])))
        several = F.explode(F.array(*hashes)).alias("hash")
        longer = slot_map(chain.select(several).where(F.col("hash").isNotNull()), slots, min_count)
        for n in range(3, max_words + 1):
            length = length.when(F.col(names[n - 1]).isNull() | ~_set(longer, slots, *names[:n]), n - 1)
    cut = whole.withColumn("kept", length.otherwise(max_words))
    cut = cut.select("lang", *(F.when(F.col("kept") >= n, F.col(name)).otherwise(F.lit("")).alias(name) for n, name in enumerate(names, 1)))
    counted = cut.groupBy("lang", *names).agg(F.count("*").alias("n"))
    rolled = counted.rollup("lang", *names).agg(F.sum("n").alias("f"))
    # Of a rolled-up row the words kept are its phrase; one that ends in padding is none.
    phrase = F.array_compact(F.array(*names))
    enough = (F.col("f") >= min_count) | (F.size("words") == 0)
    return rolled.where(F.col("lang").isNotNull()).select("lang", phrase.alias("words"), "f").where(enough & ~F.array_contains("words", ""))


def _key(words: Column) -> Column:
    """Of a phrase in its language; words hold no line break, so the two do not mix."""
    return F.concat_ws("\n", F.array_join(words, " "), "lang")


def _best_cuts(candidates: DataFrame, phrases: DataFrame) -> DataFrame:
    """(key, l, r, score): the cut of each candidate with the lowest score, the first of equals."""
    size = F.size("words")
    cuts = candidates.select("key", "lang", "words", "a", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    parts = F.array(
        F.struct(F.lit(True).alias("first"), _key(F.slice("words", F.lit(1), F.col("k"))).alias("part")),
        F.struct(F.lit(False).alias("first"), _key(F.slice("words", F.col("k") + 1, size - F.col("k"))).alias("part")),
    )
    asked = cuts.select("key", "a", "k", F.inline(parts))
    # A word may be a part of very many candidates.
    counted = salted_join(asked, phrases.select(F.col("key").alias("part"), "f"), "part", "inner", ["key"])
    sides = counted.groupBy("key", "a", "k").agg(F.max(F.when(F.col("first"), F.col("f"))).alias("l"), F.max(F.when(~F.col("first"), F.col("f"))).alias("r"))
    exact = "cast(a AS decimal(20,0)) * cast(2000000 AS decimal(7,0)) div (cast(l AS decimal(20,0)) + cast(r AS decimal(20,0)))"
    cut = F.struct(F.expr(exact).alias("score"), "k", "l", "r")
    return sides.select("key", cut.alias("cut")).groupBy("key").agg(F.min("cut").alias("cut")).select("key", "cut.l", "cut.r", "cut.score")


def _covers(candidates: DataFrame) -> DataFrame:
    """(key, over): the count of the most frequent longer candidate around each phrase inside one."""
    size = F.size("words")
    inner = candidates.where(size > 2).select("lang", "words", "a", F.explode(F.sequence(F.lit(2), size - 1)).alias("k"))
    placed = inner.select("lang", "words", "a", "k", F.explode(F.sequence(F.lit(1), size - F.col("k") + 1)).alias("at"))
    return placed.select(_key(F.slice("words", F.col("at"), F.col("k"))).alias("key"), "a").groupBy("key").agg(F.max("a").alias("over"))


def first_of_each(df: DataFrame, by: str, order: list[Column], top: int, spread: str) -> DataFrame:
    """``df`` with ``rank``: the first ``top`` rows of each group, found in parts first so no task takes a whole group."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    out = df.withColumn("part", F.pmod(F.xxhash64(spread), F.lit(parts)))
    for keys in ((by, "part"), (by,)):
        out = out.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= top)
    return out.drop("part")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, top: int = TOP, share: int = 80, slots: int = SLOTS) -> DataFrame:
    """Of each language the ``top`` phrases: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``.

    Texts are lower-cased (A-Z), cut into pieces at ``[.,;:!?\\x0A-\\x0D]`` and
    those into words at blanks and tabs.  A candidate has 2 to ``max_words``
    words and a = f(phrase) >= ``min_count``; its score is
    ``2000000 a div (l + r)`` of the cut where that is lowest (of equals the
    first).  A candidate inside a longer one with ``100 f >= share a`` goes.
    Order: score, then a, descending, then the phrase by its bytes.  A null
    language is ``und``; null and empty texts have no words; repeated rows
    count each; an empty table, or one without candidates, gives no row; other
    columns are ignored.  ``slots`` (a power of two) bounds the memory of the bit maps only.
    """
    phrases = pin(frequent_phrases(docs, text_col, lang_col, min_count, max_words, slots).withColumn("key", _key(F.col("words"))))
    candidates = pin(phrases.where(F.size("words") >= 2).withColumnRenamed("f", "a"))
    covered = candidates.join(_covers(candidates), "key", "left")
    wide = "decimal(20,0)"
    stays = F.col("over").isNull() | (F.col("over").cast(wide) * 100 < F.col("a").cast(wide) * share)
    scored = covered.where(stays).join(_best_cuts(candidates, phrases), "key")
    named = scored.select("lang", F.array_join("words", " ").alias("phrase"), "a", "l", "r", "score")
    best = first_of_each(named, "lang", [F.desc("score"), F.desc("a"), F.asc("phrase")], top, "phrase")
    totals = phrases.where(F.size("words") == 0).select("lang", F.col("f").alias("n"))
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
