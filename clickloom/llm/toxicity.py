"""Toxicity by two class-conditional Kneser-Ney models.

The models give the probability of a word in toxic and in ordinary text.  A
word's weight in a class is its number of distinct left neighbours there (the
Kneser-Ney continuation count) less a discount for counts of one, two and more;
what the discounts free goes to the continuation counts of both classes
together.  A rare expression has nothing left of its own, so both models fall
back on the same shared value and it speaks for neither side.

All labelled rows that are not held out are counted.  The words with the most
neighbours, up to ``MAX_WORDS``, are sent to every task; the others, when there are
more, stay in a table that texts are joined with, so that no word goes without its
own weight.

A text's evidence is the difference of the two log-likelihoods over each run of
1, 2, 4 and 16 words and over the whole text, divided by the run's length, the
largest of each length.  A logistic regression, fitted on learning rows that the
models did not count, makes it one probability.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.lookups import salted_join
from .common import Words, pin, release, unused, with_columns, word_blocks
from .learning import Logistic, all_labelled, chance

#: Words whose weights are sent to every task, 16 bytes each; texts are joined with those of the others.
MAX_WORDS = 1 << 21
RUNS = (1, 2, 4, 16)
#: Text taken at once: the runs' sums take some hundred bytes a word.
TEXT_BYTES = 1 << 20
#: The part of the learning rows that the regression gets.
TUNING = 0.2


def discounts(counts: list[int]) -> list[float]:
    """Kneser-Ney discounts of counts 1, 2 and 3 or more, from how many words have counts 1 to 4."""
    n1, n2, n3, n4 = (max(1, n) for n in counts)
    y = n1 / (n1 + 2 * n2)
    return [float(np.clip(k - (k + 1) * y * more / n, 0, k)) for k, n, more in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]


def look_up(known: np.ndarray, gain: np.ndarray, words: np.ndarray, other) -> np.ndarray:
    """The gain of each word among the sorted ``known`` ones, else ``other``."""
    if not len(known):
        return np.full(len(words), other)
    at = np.searchsorted(known, words)
    at[at == len(known)] = 0
    return np.where(known[at] == words, gain[at], other)


@dataclass
class ClassModels:
    """Log-likelihood difference of each known word, of any other word, and the regression.

    ``rest`` is a table (w, gain) of the known words that are not in ``words``.
    """

    words: np.ndarray
    gain: np.ndarray
    unknown: float
    score: Logistic | None
    share: float
    rest: DataFrame | None = None

    def evidence(self, words: Words, more: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
        """For each row, the largest length-normalised difference over runs of each length and over the text.

        ``more``: sorted words of the rest and their gains.
        """
        other = look_up(*more, words.hash, self.unknown) if more else self.unknown
        gain = look_up(self.words, self.gain, words.hash, other)
        first, sizes = words.first, np.diff(words.first)
        full = np.flatnonzero(sizes > 0)
        out = np.zeros((len(sizes), len(RUNS) + 1))
        if not len(full):
            return out
        total = np.concatenate(([0.0], np.cumsum(gain)))
        out[full, -1] = (total[first[1:]] - total[first[:-1]])[full] / sizes[full]
        for i, run in enumerate(RUNS):
            # The run from each word on, shorter where the text ends: only whole runs count, or the text itself.
            end = np.minimum(np.arange(len(gain)) + run, first[1:][words.row])
            mean = (total[end] - total[:-1]) / run
            mean[(end - np.arange(len(gain)) < run)] = -np.inf
            best = np.maximum.reduceat(mean, first[:-1][full])
            out[full, i] = np.where(np.isfinite(best), best, out[full, -1])
        return out

    def __call__(self, words: Words, more: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
        return self.score(self.evidence(words, more)) if self.score else np.full(len(words.first) - 1, self.share)


def neighbours(rows: DataFrame) -> DataFrame:
    """(left, word, sides) of each pair of neighbouring words in the rows, with a start mark as first left; sides: 1 and 2 for labels 0 and 1."""

    def pairs(batches):
        for batch in batches:
            for low, high, words in word_blocks(batch.column(0), TEXT_BYTES):
                if not len(words.hash):
                    continue
                left = np.concatenate(([0], words.hash[:-1])).astype(np.uint64)
                left[words.first[:-1][np.diff(words.first) > 0]] = 0
                label = batch.column(1).to_numpy()[low:high][words.row]
                # Each pair once per block; which ones the classes share is counted later.
                found = np.unique(np.stack([left, words.hash, label.astype(np.uint64) + np.uint64(1)]), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(found[0].view(np.int64)), pa.array(found[1].view(np.int64)), pa.array(found[2].astype(np.int32))], ["v", "w", "sides"])

    return rows.select("text", "label").mapInArrow(pairs, "v long, w long, sides int")


def word_counts(rows: DataFrame) -> DataFrame:
    """(w, t, o, both): how many distinct left neighbours each word has in rows of label 1, of label 0 and in all."""
    seen = neighbours(rows).groupBy("v", "w").agg(F.bit_or("sides").alias("sides"))
    side = F.col("sides")
    return seen.groupBy("w").agg(F.count_if(side.bitwiseAND(2) > 0).alias("t"), F.count_if(side.bitwiseAND(1) > 0).alias("o"), F.count("*").alias("both"))


def least_sent(counts: DataFrame, max_words: int) -> int:
    """The smallest number of neighbours such that at most ``max_words`` words have as many."""
    words = 0
    # Different numbers are few: their sum is at most that of all pairs.
    for row in counts.groupBy("both").count().orderBy(F.desc("both")).toLocalIterator():
        words += row["count"]
        if words > max_words:
            return row["both"] + 1
    return 1


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id", text_col: str = "text", max_words: int = MAX_WORDS) -> ClassModels:
    """Models of label 1 against label 0, from all learning rows of ``labels``.

    Spark counts them all and sums up the regression's steps; only words' weights,
    ``max_words`` at most, come to the driver.  Without rows of both labels
    every score is the share of label 1.
    """
    tuning, counted, share = all_labelled(docs, labels, label, chance(F.col("id"), 12) < TUNING, id_col, text_col)
    counts = pin(word_counts(counted))
    sums = [F.sum("t").alias("t"), F.sum("o").alias("o"), F.sum("both").alias("both"), F.count("*").alias("words")]
    stats = counts.agg(*sums, *(F.count_if(F.col(c) == i).alias(f"{c}{i}") for c in "to" for i in (1, 2, 3, 4)), *(F.count_if(F.col(c) >= 3).alias(f"{c}more") for c in "to")).head()
    none = ClassModels(np.zeros(0, np.uint64), np.zeros(0), 0.0, None, share)
    if not stats.t or not stats.o:
        return none
    shared = (F.col("both") + 0.5) / (stats.both + 0.5 * stats.words)
    gain, none.unknown = F.lit(0.0), 0.0
    for sign, c in ((1.0, "t"), (-1.0, "o")):
        less = discounts([stats[f"{c}{i}"] for i in (1, 2, 3, 4)])
        # What the discounts free; where that is nothing, unknown words still need a logarithm.
        rest = max(sum(d * stats[f"{c}{i}"] for d, i in zip(less, (1, 2, "more"), strict=True)), 1e-6) / stats[c]
        off = F.when(F.col(c) == 0, 0.0).when(F.col(c) == 1, less[0]).when(F.col(c) == 2, less[1]).otherwise(less[2])
        gain += F.log((F.col(c) - off) / stats[c] + rest * shared) * sign
        none.unknown += sign * float(np.log(rest))
    weights = counts.select("w", gain.alias("gain"), "both")
    least = least_sent(counts, max_words) if stats.words > max_words else 1
    # At most ``max_words`` rows.
    kept = weights.where(F.col("both") >= least).select("w", "gain").toArrow()
    none.words, none.gain = kept["w"].to_numpy().view(np.uint64), kept["gain"].to_numpy()
    del kept
    order = np.argsort(none.words)
    none.words, none.gain = none.words[order], none.gain[order]
    release()
    if least > 1:
        none.rest = pin(weights.where(F.col("both") < least).select("w", "gain"))
    rows = pin(evidence(tuning, none))
    if len(rows.select("label").distinct().head(2)) == 2:
        none.score = Logistic(rows)
    return none


def with_rest(docs: DataFrame, models: ClassModels, text_col: str, out: str) -> DataFrame:
    """``docs`` with ``out``: the words of the text that are in ``models.rest``, with their gains; null without such words.

    Equal texts are looked up once.  The texts themselves are joined by their digest.
    """
    key = unused(docs, "text_digest")
    keyed = docs.withColumn(key, F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)))
    sent = docs.sparkSession.sparkContext.broadcast(models.words)

    def others(batches):
        for batch in batches:
            for low, high, words in word_blocks(batch.column(1), TEXT_BYTES):
                known = sent.value
                new = known[np.minimum(np.searchsorted(known, words.hash), len(known) - 1)] != words.hash if len(known) else np.ones(len(words.hash), bool)
                found = np.unique(np.stack([words.row[new].astype(np.uint64), words.hash[new]]), axis=1)
                digests = batch.column(0)[low:high].take(pa.array(found[0].astype(np.int64)))
                yield pa.RecordBatch.from_arrays([digests, pa.array(found[1].view(np.int64))], ["k", "w"])

    asked = keyed.select(key, text_col).mapInArrow(others, "k binary, w long").distinct()
    found = salted_join(asked, models.rest, "w", "inner", ["k"]).groupBy("k").agg(F.collect_list(F.struct("w", "gain")).alias(out))
    # Copies of one text may be very many.
    facts = keyed.withColumn(spread := unused(keyed, "spread"), F.monotonically_increasing_id())
    return salted_join(facts, found.withColumnRenamed("k", key), key, "left", [spread]).drop(key, spread)


def _by_text(docs: DataFrame, models: ClassModels, text_col: str, make, outs: str) -> DataFrame:
    """``docs`` with the columns ``outs`` that ``make`` gives for blocks of (words, words of the rest)."""
    rest = unused(docs, "rest_words")
    sources, joined = [text_col], docs
    if models.rest is not None:
        sources, joined = [text_col, rest], with_rest(docs, models, text_col, rest)

    def blocks(column, lists=None):
        for low, high, words in word_blocks(column, TEXT_BYTES):
            more = None
            if lists is not None:
                pairs = lists[low:high].flatten()
                known, at = np.unique(pairs.field("w").to_numpy().view(np.uint64), return_index=True)
                more = known, pairs.field("gain").to_numpy()[at]
            yield words, more

    return with_columns(joined, sources, lambda *columns: make(blocks(*columns)), outs).drop(rest)


def evidence(sample: DataFrame, models: ClassModels) -> DataFrame:
    """``sample`` with the array ``evidence``, without its text."""
    sent = sample.sparkSession.sparkContext.broadcast(replace(models, rest=None))

    def make(blocks):
        return [pa.array([row for words, more in blocks for row in sent.value.evidence(words, more).tolist()], pa.list_(pa.float64()))]

    return _by_text(sample, models, "text", make, "evidence array<double>").drop("text")


def score(docs: DataFrame, models: ClassModels, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the double ``out`` in [0, 1]: how likely label 1 is.

    A null text is the empty text, which has no evidence for either side.  A
    column called ``out`` is replaced; all other columns and rows stay.
    """
    sent = docs.sparkSession.sparkContext.broadcast(replace(models, rest=None))

    def make(blocks):
        found = [sent.value(words, more) for words, more in blocks]
        return [pa.array(np.concatenate(found) if found else np.zeros(0))]

    return _by_text(docs, models, text_col, make, f"`{out}` double")


def drop_toxic(docs: DataFrame, models: ClassModels, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with all their columns."""
    key = unused(docs, "toxicity")
    return score(docs, models, text_col, key).where(F.col(key) < threshold).drop(key)
