import hashlib
import random

import numpy as np
import pytest

from clickloom.llm import substrings
from clickloom.llm.queries import op7_suffix_dedup
from clickloom.llm.substrings import drop_repeats, owners, segments

SF = "/root/testdata/sf0.001"


def brute(rows, size=50):
    """{id: (bytes, removed, spans, what stays)} by a table of all windows."""
    raw = {i: (t or "").encode() for i, t in rows}
    first = {}
    for i in sorted(raw):
        for s in range(len(raw[i]) - size + 1):
            first.setdefault(raw[i][s : s + size], i)
    out = {}
    for i, text in raw.items():
        gone = np.zeros(len(text), bool)
        for s in range(len(text) - size + 1):
            if first[text[s : s + size]] < i:
                gone[s : s + size] = True
        spans = int((gone & ~np.concatenate(([False], gone[:-1]))).sum()) if len(gone) else 0
        out[i] = len(text), int(gone.sum()), spans, bytes(np.frombuffer(text, np.uint8)[~gone]) if text else b""
    return out


def result(df):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in df.collect()}


def test_query_matches_table_of_windows(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    expected = {i: (*v[:3], hashlib.sha256(v[3]).hexdigest()) for i, v in brute(rows).items()}
    assert {r.doc_id: tuple(r)[1:] for r in op7_suffix_dedup(spark, SF).collect()} == expected


def test_small_alphabet(spark):
    rng = random.Random(4)
    pieces = ["".join(rng.choices("abé", k=rng.randint(5, 40))) for _ in range(8)]
    rows = [(i, "".join(rng.choices(pieces, k=rng.randint(0, 9)))) for i in range(40)] + [(50, "a" * 500), (51, "b" + "a" * 300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(drop_repeats(docs, size=20)) == brute(rows, 20)


def test_odd_rows(spark):
    long = "".join(chr(97 + (i * i) % 23) + chr(97 + i % 11) for i in range(60_000))
    rows = [(1, None), (2, ""), (3, long), (4, long), (5, "x" + long[1000:3000] + "y"), (6, "short"), (7, "short"), (8, long[:49]), (9, long[100:150])]
    docs = spark.createDataFrame([(*r, "old", 1) for r in rows], "doc_id long, text string, kept string, id int")
    assert result(drop_repeats(docs)) == brute(rows)
    assert result(drop_repeats(docs.limit(0))) == {}
    part = long[:200]
    twice = spark.createDataFrame([(2, part), (2, part), (2, "z" + part), (None, part[:60])], "doc_id long, text string")
    got = sorted((r.doc_id is None, r.n_removed, r.n_spans) for r in drop_repeats(twice).collect())
    assert got == [(False, 60, 1)] * 3 + [(True, 0, 0)]


def test_equal_windows_have_equal_minimizers():
    rng = np.random.default_rng(1)
    data = rng.integers(97, 101, 400).astype(np.uint8)
    data[250:330] = data[20:100]
    value, row, start, end = segments(data, np.array([0, 200, 400]), 50)
    of = {}
    for v, r, s, e in zip(value, row, start, end):
        assert (e <= 200) == (r == 0)
        of |= {i: v for i in range(s, e - 49)}
    assert len(of) == 2 * 151
    assert all(of[i] == of[i + 230] for i in range(20, 51))


def test_owner_is_the_smallest_holder():
    text = b"abcdefghij" + b"zabcdefgh!" + b"qqqqqqqqqq"
    data, low, high = np.frombuffer(text, np.uint8), np.array([0, 10, 20]), np.array([10, 20, 30])
    got = owners(np.array([7, 7, 8], np.uint64), data, low, high, np.array([5, 3, 9]), 4)
    assert got.tolist() == [3, 3, 3, 3, 3, 5, 5] + [3] * 7 + [9] * 7


@pytest.mark.parametrize("shard", [1, 300, 1 << 20])
def test_shards_do_not_change_owners(monkeypatch, shard):
    monkeypatch.setattr(substrings, "SHARD_BYTES", shard)
    rng = np.random.default_rng(6)
    values, least = np.sort(rng.integers(0, 6, 30)).astype(np.uint64), rng.permutation(30)
    # Equal windows have equal minimizers: each has letters of its own.
    parts = [(97 + 2 * int(v) + rng.integers(0, 2, n)).astype(np.uint8) for v, n in zip(values, rng.integers(8, 40, 30))]
    ends = np.cumsum([len(p) for p in parts])
    got = iter(owners(values, np.concatenate(parts), ends - [len(p) for p in parts], ends, least, 8).tolist())
    for part, value in zip(parts, values):
        for i in range(len(part) - 7):
            window = part[i : i + 8].tobytes()
            assert next(got) == min(x for p, v, x in zip(parts, values, least) if v == value and window in p.tobytes())
