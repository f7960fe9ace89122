import random
import re
from collections import Counter

import pytest

from clickloom.llm.phrases import collocations, frequent_phrases, piece_words, windows

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def pieces(text):
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER))]


def counts(rows, max_words=4):
    f = {}
    for lang, text in rows:
        own = f.setdefault("und" if lang is None else lang, Counter())
        for w in pieces(text):
            own[()] += len(w)
            own.update(tuple(w[i : i + k]) for k in range(1, max_words + 1) for i in range(len(w) - k + 1))
    return f


def brute(rows, min_count=30, max_words=4, top=2000, share=80):
    out = []
    for lang, f in counts(rows, max_words).items():
        found = []
        for p, a in f.items():
            if len(p) < 2 or a < min_count:
                continue
            score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            around = [n for q, n in f.items() if len(q) > len(p) and n >= min_count and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if not any(100 * n >= share * a for n in around):
                found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, rank, p.decode(), -a, l, r, f[()], -s) for rank, (s, a, p, l, r) in enumerate(sorted(found)[:top], 1)]
    return out


def corpus(seed=1, size=120):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(12)] + ["The", "Élan", "ß", "über-all", "x\x00y"]
    ends = [" ", "\t", "  ", ". ", ",", ";", ":", "!", "?", "\n", "\x0b", "\x0c", "\r"]
    rows = []
    for _ in range(size):
        words = rng.choices(vocabulary, [1 / (i + 1) for i in range(len(vocabulary))], k=rng.randrange(40))
        text = "".join(w + rng.choices(ends, [9, 2, 1] + [0.5] * 10)[0] for w in words)
        rows.append((rng.choice(["en", "en", "de", None, ""]), text + "New  York\tstate law. " * rng.randrange(2)))
    return rows


ODD = [("en", None), (None, None), ("fr", ""), ("fr", " \t.,"), ("fr", "alone"), ("und", "w0 w1 w0 w1")]


def table(spark, rows):
    return spark.createDataFrame([(t, lang, "n", 1.0) for lang, t in rows], "text string, lang string, n string, score double").repartition(3)


@pytest.mark.parametrize("slots", [64, 1 << 16])
@pytest.mark.parametrize("options", [{"min_count": 8}, {"min_count": 3, "max_words": 3, "top": 7}, {"min_count": 5, "share": 30, "top": 1}])
def test_matches_plain_version(spark, rows, options, slots):
    """A bit map with very few slots marks nearly everything and changes no count."""
    data = corpus() + ODD
    found = collocations(table(spark, data), slots=slots, **options)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert rows(found) == sorted(brute(data, **options), key=repr)


def test_all_frequent_phrases_are_counted(spark):
    data = corpus(2)
    found = {(r.lang, tuple(r.words)): r.f for r in frequent_phrases(table(spark, data), min_count=4, slots=1 << 16).collect()}
    assert found == {(lang, p): n for lang, f in counts(data).items() for p, n in f.items() if n >= 4 or not p}


def test_repeated_rows_count_each(spark, rows):
    data = [("en", "Big apple pie")] * 30 + [("en", "big apple")] * 20
    assert rows(collocations(table(spark, data))) == sorted(brute(data), key=repr)


def test_empty_table_and_no_candidates(spark):
    assert collocations(table(spark, [("en", "a b")]).limit(0)).collect() == []
    assert collocations(table(spark, [("en", "a b")])).collect() == []


def test_windows_are_padded_at_the_end_of_a_piece(spark):
    words = spark.createDataFrame([("en", ["a", "b", "c"]), ("en", [])], "lang string, w array<string>")
    assert [tuple(r)[1:] for r in windows(words, 4).collect()] == [("a", "b", "c", None), ("b", "c", None, None), ("c", None, None, None)]


def test_long_text_without_pieces(spark):
    (row,) = collocations(table(spark, [("en", "tick tock " * 200_000)]), top=1).collect()
    # The longest phrases cover all shorter ones; of two equal ones the smaller comes first.
    assert (row.phrase, row.a, row.n) == ("tick tock tick tock", 199_999, 400_000)


def test_arithmetic_passes_64_bits(spark):
    from clickloom.llm.phrases import _best_cuts, _key
    from pyspark.sql import functions as F

    big = 9 * 10**18
    phrases = spark.createDataFrame([("en", ["a", "b"], big), ("en", ["a"], big), ("en", ["b"], big + 1)], "lang string, words array<string>, f long")
    phrases = phrases.withColumn("key", _key(F.col("words")))
    (row,) = _best_cuts(phrases.where(F.size("words") == 2).withColumnRenamed("f", "a"), phrases).collect()
    assert (row.l, row.r, row.score) == (big, big + 1, 2_000_000 * big // (2 * big + 1))


def test_pieces_and_words_of_every_kind_of_character(spark):
    """Only A-Z is lowered, only the listed characters cut, bytes of longer characters are left alone."""
    every = "".join(map(chr, [*range(0x250), 0x2028, 0x3000, 0x65E5, 0x1F642]))
    given = [every, every[::-1], " ".join(every), None, "", "\t \n.", "ÀÉ. A\tb\x0b\x0cÇ;d\re", "x" * 70_000 + " Y"]
    docs = spark.createDataFrame([(t, i) for i, t in enumerate(given)], "text string, lang int")
    found = sorted((r.lang, r.w) for r in piece_words(docs, "text", "lang").collect())
    lowered = [re.sub("[A-Z]", lambda m: m[0].lower(), t or "") for t in given]
    assert found == sorted((str(i), [w for w in re.split("[ \t]", piece) if w]) for i, t in enumerate(lowered) for piece in re.split("[.,;:!?\n\x0b\x0c\r]", t))
    assert piece_words(docs.limit(0), "text", "lang").collect() == []
    # One pass over bytes instead of a look-up of every character.
    assert "translate" not in piece_words(docs, "text", "lang")._jdf.queryExecution().toString()
