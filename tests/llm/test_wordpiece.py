import random

import numpy as np
import pytest

from clickloom.llm.pieces import MARK, MODEL, NORMAL, Model
from clickloom.llm.queries import op1_token_counts
from clickloom.llm.wordpiece import Automaton, token_counts

SF = "/root/testdata/sf0.001"


def greedy(word: bytes, pieces: set[bytes], longest: int) -> int:
    """Pieces of a word, cut at the longest match again and again."""
    at = count = 0
    while at < len(word):
        size = next(n for n in range(min(longest, len(word) - at), 0, -1) if n == 1 or word[at : at + n] in pieces)
        at, count = at + size, count + 1
    return count


def expected(text, pieces, longest):
    words = (text or "").encode().split()
    return sum(greedy(MARK.encode() + w, pieces, longest) for w in words)


@pytest.fixture(scope="module")
def vocabulary():
    with open(MODEL, "rb") as file:
        found = {p.encode() for p, _, kind in Model.parse(file.read()).pieces if kind == NORMAL}
    return found, max(map(len, found))


@pytest.mark.parametrize("seed", range(5))
def test_automaton_is_greedy(seed):
    rng = random.Random(seed)
    pieces = {bytes(rng.choices(b"ab", k=rng.randint(1, 6))) for _ in range(12)}
    automaton = Automaton(sorted(pieces), b"")
    words = [bytes(rng.choices(b"abc", k=rng.randint(0, 40))) for _ in range(60)]
    ends = np.cumsum([len(w) for w in words])
    got = automaton.count(np.frombuffer(b"".join(words), np.uint8), np.concatenate(([0], ends[:-1])), ends)
    assert got.tolist() == [greedy(w, pieces, 6) for w in words]


def test_query_matches_greedy_cutting(spark, vocabulary):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = op1_token_counts(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        text = texts[r.doc_id] or ""
        assert (r.n_bytes, r.n_words, r.n_tokens) == (len(text.encode()), len(text.encode().split()), expected(text, *vocabulary))


def test_odd_rows(spark, vocabulary):
    texts = [None, "", " \n ", "x" * 100_000, "日本 🙂\x00é", "a", "a", f"{MARK}a {MARK * 3}"]
    docs = spark.createDataFrame([(t, i, "old") for i, t in enumerate(texts)], "text string, doc_id long, n_words string")
    got = {r.doc_id: r for r in token_counts(docs).collect()}
    for i, text in enumerate(texts):
        assert (got[i].n_tokens, got[i].text) == (expected(text, *vocabulary), text)
    assert token_counts(docs.limit(0)).collect() == []
