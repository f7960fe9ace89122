import re
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from clickloom.llm.components import contract
from clickloom.llm.queries import op13_simhash
from clickloom.llm.simhash import fingerprint, links, simhash_classes

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_fingerprint(text):
    words = WORD.findall((text or "").translate(LOWER))
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum((sum(h >> bit & 1 for h in hashes) * 2 > len(hashes)) << bit for bit in range(64))


def plain_components(edges, nodes):
    label = {n: n for n in nodes}
    for a, b in edges:
        old, new = sorted((label[a], label[b]), reverse=True)
        for n in nodes:
            if label[n] == old:
                label[n] = new
    return label


def brute(rows):
    prints = [plain_fingerprint(t) for _, t in rows]
    distinct = sorted(set(prints))
    near = [(a, b) for a, b in combinations(distinct, 2) if (a ^ b).bit_count() <= 2]
    label = plain_components(near, distinct)
    least = {}
    for (i, _), p in zip(rows, prints):
        if i is not None:
            least[label[p]] = min(i, least.get(label[p], i))
    return [(i, f"{p:016x}", least.get(label[p])) for (i, _), p in zip(rows, prints)]


def result(df):
    return sorted(((r.doc_id, r.fingerprint, r.component_id) for r in df.collect()), key=repr)


def test_query_matches_all_pairs(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert result(op13_simhash(spark, SF)) == sorted(brute(rows), key=repr)


def test_hash_is_that_of_spark(spark):
    words = "one two thrée"
    ours = spark.range(1).select(F.xxhash64(F.lit(words))).head()[0]
    assert ours % 2**64 == xxhash.xxh64_intdigest(words.encode(), 42) == fingerprint(words.encode())


@pytest.mark.parametrize("limit", [1, 2, 13, 1 << 18])
def test_parts_give_the_fingerprint_of_the_whole(limit):
    for text in ("", " \t\n", "One", "a b", "A b\x0bC\x0cd\re", "x" * 40 + " y  z\n" * 9, "ä Ö ü " * 7, "  lead and trail  "):
        assert fingerprint(text.encode(), limit=limit) == plain_fingerprint(text), text


def test_odd_rows(spark):
    text = "the quick brown fox jumps over the lazy dog " * 3
    rows = [(5, None), (3, ""), (None, " "), (7, text), (7, text), (None, text), (9, text.upper()), (1, "word"), (2, "two words"), (8, "long " * 300_000)]
    docs = spark.createDataFrame([(*r, 1, "f") for r in rows], "doc_id long, text string, fp int, fingerprint string").repartition(3)
    assert result(simhash_classes(docs)) == sorted(brute(rows), key=repr)
    nameless = spark.createDataFrame([(None, "a"), (None, "a")], "doc_id long, text string")
    assert {r.component_id for r in simhash_classes(nameless).collect()} == {None}
    assert simhash_classes(docs.limit(0)).collect() == []


def signed(values):
    return [(int(np.uint64(v).astype(np.int64)),) for v in values]


@pytest.mark.parametrize("crowd", [1, 4, 1000])
def test_crowded_places_lose_no_link(spark, crowd):
    """Dense neighbourhoods in one segment, chains over many, and loners."""
    rng = np.random.default_rng(5)
    values = set()
    for _ in range(6):
        base = int(rng.integers(0, 2**63)) * 2 + 1
        for _ in range(60):
            flips = rng.choice(64, rng.integers(0, 5), replace=False) if rng.random() < 0.5 else rng.choice(8, rng.integers(0, 5), replace=False)
            values.add(base ^ sum(1 << int(f) for f in flips))
        for i in range(0, 40, 2):
            base ^= 3 << i
            values.add(base)
    values |= {int(v) for v in rng.integers(0, 2**63, 40)} | {0, 1 << 63, (1 << 64) - 1}
    near = [(a, b) for a, b in combinations(sorted(values), 2) if (a ^ b).bit_count() <= 2]
    nodes = spark.createDataFrame(signed(values), "fp long").repartition(4)
    found = [(r.a % 2**64, r.b % 2**64) for r in links(nodes, crowd).collect()]
    assert {frozenset(p) for p in found} <= {frozenset(p) for p in near}
    assert plain_components(found, values) == plain_components(near, values)
    if crowd == 1000:
        assert {frozenset(p) for p in found} == {frozenset(p) for p in near}


def test_crowded_places_give_rows_in_proportion(spark):
    """4,096 fingerprints in one place of each table: pairs would be eight million."""
    values = [(i << 40) | (i & 63) for i in range(4096)]
    nodes = spark.createDataFrame(signed(values), "fp long")
    assert links(nodes).count() <= 65 * len(values)


@pytest.mark.parametrize("shape", ["path", "star", "clique", "loops"])
def test_components(spark, shape):
    edges = {
        "path": [(i, i + 1) for i in range(400)] + [(1000, 1001)],
        "star": [(0, i) for i in range(1, 300)] + [(i, 500 + i) for i in range(1, 300)],
        "clique": list(combinations(range(20), 2)) + [(b, a) for a, b in combinations(range(30, 40), 2)],
        "loops": [(1, 1), (2, 3), (3, 2), (2, 3)],
    }[shape]
    nodes = {n for e in edges for n in e}
    roots = {r.node: r.root for r in contract(spark.createDataFrame(edges, "a long, b long")).collect()}
    label = plain_components(edges, nodes)
    assert set(roots) == nodes
    assert len({(roots[n], label[n]) for n in nodes}) == len(set(roots.values())) == len(set(label.values()))


def jobs_of(spark, work):
    spark.sparkContext.setJobGroup(name := f"count-{work}", "")
    try:
        return work(), len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_a_star_takes_few_jobs(spark):
    """Rounds that halve its leaves, each join with keys counted anew, took 234 jobs: their plans filled the driver's memory."""
    edges = spark.createDataFrame([(0, i) for i in range(1, 1000)] + [(5000, 5000 + i) for i in range(1, 1000)], "a long, b long")
    roots, jobs = jobs_of(spark, lambda: {r.node: r.root for r in contract(edges).collect()})
    assert len(roots) == 2000 and len(set(roots.values())) == 2
    assert jobs <= 60


@pytest.mark.parametrize("kind", ["long", "binary"])
def test_hubs_are_split(spark, monkeypatch, kind):
    monkeypatch.setattr("clickloom.llm.components.HOT_LINKS", 1)
    edges = [(0, i) for i in range(1, 300)] + [(i, 500 + i) for i in range(1, 300)] + [(900, i) for i in range(901, 990)]
    made = spark.createDataFrame(edges, "a long, b long").select(*(F.col(c).cast("string").cast("binary").alias(c) if kind == "binary" else F.col(c) for c in "ab"))
    roots = {int(r.node): int(r.root) for r in contract(made).collect()}
    label = plain_components(edges, {n for e in edges for n in e})
    assert set(roots) == set(label) and len({(roots[n], label[n]) for n in label}) == len(set(roots.values())) == 2


def test_nulls_connect_nothing(spark):
    found = contract(spark.createDataFrame([(1, None), (None, 2), (None, None), (2, 3)], "a long, b long")).collect()
    roots = {r.node: r.root for r in found}
    assert len(found) == 4 and roots[None] is None and roots[1] == 1 and roots[2] == roots[3]


def test_no_edges(spark):
    assert contract(spark.createDataFrame([], "a long, b long")).collect() == []
