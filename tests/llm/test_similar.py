import re
from itertools import combinations

import numpy as np
import pytest

from clickloom.llm.queries import op9_similar
from clickloom.llm.similar import near_copies, overlaps, prefix_length

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, size=5):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def brute(rows, threshold=0.8):
    """{id: (class_id, n_links, group_size)} by comparing all pairs."""
    sets = {i: shingles(t) for i, t in rows}
    near = {i: set() for i in sets}
    for a, b in combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if sets[a] and sets[b] and both >= threshold * (len(sets[a]) + len(sets[b]) - both) - 1e-9:
            near[a].add(b)
            near[b].add(a)
    label = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for i in sets:
            least = min([label[i], *(label[j] for j in near[i])])
            changed, label[i] = changed or least != label[i], least
    return {i: (label[i], len(near[i]), sum(s == sets[i] for s in sets.values()) if sets[i] else 1) for i in sets}


def result(df):
    return {r.doc_id: (r.class_id, r.n_links, r.group_size) for r in df.collect()}


def test_query_matches_all_pairs(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert result(op9_similar(spark, SF)) == brute(rows)


@pytest.mark.parametrize("block", [4, 512])
def test_large_group_of_variants(spark, block):
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(60):
        text = list(base)
        for at in rng.choice(120, rng.integers(0, 4), replace=False):
            text[at] = f"x{rng.integers(1000)}"
        rows.append((i, " ".join(text)))
    rows += [(100 + i, " ".join(f"y{rng.integers(9)}" for _ in range(40))) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got, expected = result(near_copies(docs, block=block)), brute(rows)
    links = sum(v[1] for v in expected.values())
    assert sum(v[1] for v in got.values()) >= 0.999 * links
    assert {i: v[0] for i, v in got.items()} == {i: v[0] for i, v in expected.items()}


def test_odd_rows(spark):
    long = " ".join(f"v{i}" for i in range(30_000))
    rows = [(1, None), (2, ""), (3, " . "), (4, "One two"), (5, "one TWO!"), (6, "one two three"), (7, long), (8, long + " end"), (9, "é " * 7), (10, "é " * 9)]
    docs = spark.createDataFrame([(*r, "old", 3) for r in rows], "doc_id long, text string, class_id string, n_links int")
    assert result(near_copies(docs)) == brute(rows)
    assert result(near_copies(docs.limit(0))) == {}
    twice = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f")], "doc_id long, text string")
    assert sorted(tuple(r) for r in near_copies(twice).select("class_id", "n_links", "group_size").collect()) == [(1, 2, 3)] * 3


def test_overlaps_count_common_members():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 6000, n).astype(np.uint64)) for n in (0, 1, 50, 3000, 5000)]
    got = overlaps(sets[:3], sets)
    assert got.tolist() == [[len(np.intersect1d(a, b)) for b in sets] for a in sets[:3]]


def test_prefix_is_shortened_until_the_recall():
    assert prefix_length(0.8, 16, 8, 0.999) == 4
    assert prefix_length(0.8, 16, 3, 0.999) == 3
    assert prefix_length(0.1, 2, 8, 0.99) == 1


def test_near_copies_without_an_id_keep_their_links(spark):
    base = {c: [f"{c}{i}" for i in range(60)] for c in "pq"}
    changed = lambda c, at: " ".join([*base[c][:at], "new", *base[c][at + 1 :]])
    rows = [(1, " ".join(base["p"])), (None, changed("p", 59)), (None, changed("p", 59)), (2, changed("p", 0)), (None, " ".join(base["q"])), (None, changed("q", 59)), (3, "alone"), (None, "alone too")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    expected = brute([(i, text) for i, (_, text) in enumerate(rows)])
    got = near_copies(docs).select("doc_id", "class_id", "n_links", "group_size").collect()
    named = [(1, 1), (None, 1), (None, 1), (2, 1), (None, None), (None, None), (3, 3), (None, None)]
    order = lambda x: tuple(-1 if v is None else v for v in x)
    assert sorted(map(tuple, got), key=order) == sorted(((*name, *expected[i][1:]) for i, name in enumerate(named)), key=order)
