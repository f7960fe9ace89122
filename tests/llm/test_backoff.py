import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from clickloom.llm.backoff import backoff_scores, pack, unpack
from clickloom.llm.common import byte_spans, mix

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, alpha=0.4, least=2):
    docs = [(i, WORD.findall((t or "").translate(LOWER))) for i, t in rows]
    one, two = Counter(), Counter()
    for _, w in docs:
        one.update(w)
        two.update(zip([""] + w, w))
        one[""] += bool(w)
    total = sum(n for w, n in one.items() if w)
    out = {}
    for i, w in docs:
        n, backed, score = out.get(i, (0, 0, 0.0))
        for a, b in zip([""] + w, w):
            seen = two[a, b] >= least
            score += math.log(two[a, b] / one[a]) if seen else math.log(alpha * one[b] / total)
            n, backed = n + 1, backed + (not seen)
        out[i] = n, backed, score
    return out


def check(df, expected):
    got = {r.doc_id: r for r in df.collect()}
    assert set(got) == set(expected)
    for i, (n, backed, score) in expected.items():
        r = got[i]
        assert (r.n_words, r.n_backoff) == (n, backed)
        assert r.log_score == pytest.approx(score, abs=1e-9)
        assert r.mean_log_score == (pytest.approx(score / n) if n else None)


def test_scores(spark):
    rng = random.Random(3)
    vocabulary = [f"w{int(rng.paretovariate(0.7)) % 60}" for _ in range(200)]
    rows = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(0, 60)))) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    check(backoff_scores(docs), brute(rows))
    check(backoff_scores(docs, min_count=4, alpha=0.1), brute(rows, 0.1, 4))


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " . "), (4, "One two one TWO"), (5, "é " * 30_000), (6, "one"), (7, "one two"), (-5, "two é")]
    docs = spark.createDataFrame([(*r, "old", 1) for r in rows], "doc_id long, text string, n_words string, id int")
    check(backoff_scores(docs), brute(rows))
    assert backoff_scores(docs.limit(0)).collect() == []
    twice = [(4, "one two"), (4, "one two"), (None, "two one"), (None, "one two")]
    check(backoff_scores(spark.createDataFrame(twice, "doc_id long, text string")), brute(twice))


def test_packing_gives_arrays_back():
    arrays = [np.arange(5, dtype=np.uint64), np.zeros(0, np.uint32), np.array([1.5, -2.0])]
    a, b, c = unpack(pack(*arrays), 3)
    assert a.tolist() == [0, 1, 2, 3, 4] and len(b) == 0 and c.view(np.float64).tolist() == [1.5, -2.0]


def alike(words, values):
    """Two of the words with equal values."""
    order = np.argsort(values, kind="stable")
    i = np.flatnonzero(np.diff(values[order]) == 0)[0]
    return words[order[i]], words[order[i + 1]]


def test_words_with_equal_hash_halves_are_not_merged(spark):
    words = [f"{i:06d}" for i in range(400_000)]
    at = np.arange(len(words))
    hashes = byte_spans(np.frombuffer("".join(words).encode(), np.uint8), 6 * at, 6 * at + 6)
    half = np.uint64(32)
    # Salted as other words of a pair once were, and plain; by upper and by lower half.
    pairs = [alike(words, x >> half | np.uint64(1)) for x in (mix(hashes ^ np.uint64(0xA5A5A5A5)), mix(hashes))]
    pairs += [alike(words, mix(hashes) >> half), alike(words, mix(hashes) & np.uint64(0xFFFFFFFF))]
    rows = []
    for a, b in pairs:
        assert a != b
        rows += [f"the {a}", f"the {b}", f"{a} end", f"{b} end"]
    rows = list(enumerate(rows))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    check(backoff_scores(docs), brute(rows))
