import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickloom.llm import quality, toxicity
from clickloom.llm.common import Words, texts
from clickloom.llm.queries import op5_quality, op10_toxicity

SF = "/root/testdata/sf0.1"


def auc(score, y):
    rank = np.argsort(np.argsort(score))
    n = y.sum()
    return (rank[y == 1].sum() - n * (n - 1) / 2) / (n * (len(y) - n))


def judged(spark, query, label):
    rows = query(spark, SF).toPandas()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert rows.score.between(0, 1).all()
    held = [zlib.crc32(str(i).encode()) % 5 == 0 for i in rows.doc_id]
    assert rows.held_out.tolist() == held
    return rows[rows.held_out].merge(spark.read.parquet(f"{SF}/labels.parquet").toPandas(), on="doc_id")


def test_quality_on_held_out_rows(spark):
    rows = judged(spark, op5_quality, "quality")
    assert (rows.predicted == (rows.score >= 0.3)).all()
    assert auc(rows.score.to_numpy(), rows.quality.to_numpy()) > 0.99
    assert (rows.predicted == rows.quality).mean() > 0.97


def test_toxicity_on_held_out_rows(spark):
    rows = judged(spark, op10_toxicity, "toxic")
    assert (rows.predicted == (rows.score >= 0.5)).all()
    assert auc(rows.score.to_numpy(), rows.toxic.to_numpy()) > 0.95
    assert (rows.predicted == rows.toxic).mean() > 0.97
    assert rows.predicted[rows.toxic == 0].mean() < 0.01


def training_rows():
    """Odd ids have one telling word and even ones another, among words that tell nothing."""
    return [(i, " ".join(f"w{(7 * i + j) % 50} {'vile' if i % 2 else 'kind'}" for j in range(2 + i % 5))) for i in range(100, 200)]


ODD = [(1, None), (2, ""), (3, "a"), (4, "vile " * 50_000), (5, "kind words only"), (None, "kind words"), (3, "a")]


@pytest.mark.parametrize("module, label", [(toxicity, "toxic"), (quality, "quality")])
def test_odd_rows(spark, module, label):
    train = training_rows()
    labels = [(i, i % 2) for i, _ in train] + [(100, 0), (3, None), (None, 1)]
    docs = spark.createDataFrame([(*r, "old", 1.0) for r in [*train, *ODD]], "doc_id long, text string, label string, score double")
    marks = spark.createDataFrame(labels, f"doc_id long, {label} int")
    out = module.score(docs, module.fit(docs, marks))
    assert out.columns == ["doc_id", "text", "label", "score"]
    rows = out.collect()
    assert len(rows) == len(train) + len(ODD) and all(0 <= r.score <= 1 for r in rows)
    learned = {r.doc_id: r.score for r in rows if r.doc_id and r.doc_id >= 100}
    assert min(s for i, s in learned.items() if i % 2) > max(s for i, s in learned.items() if not i % 2)
    # Without rows to learn from, every score is the share of label 1.
    nothing = module.fit(docs, marks.limit(0))
    assert module.score(docs.limit(0), nothing).collect() == []
    assert len({round(r.score, 6) for r in module.score(docs, nothing).collect()}) == 1
    one = module.fit(docs, marks.where(f"{label} = 1"))
    assert all(r.score > 0.9 for r in module.score(docs, one).collect())


def test_toxic_documents_go_with_nothing_else(spark):
    train = training_rows()
    docs = spark.createDataFrame([(*r, 7) for r in [*train, *ODD]], "doc_id long, text string, toxicity int")
    marks = spark.createDataFrame([(i, i % 2) for i, _ in train], "doc_id long, toxic int")
    left = toxicity.drop_toxic(docs, toxicity.fit(docs, marks))
    assert left.columns == docs.columns
    assert sorted((r.doc_id or 0) for r in left.collect() if (r.doc_id or 0) >= 100) == [i for i, _ in train if not i % 2]
    assert {r.doc_id for r in left.collect()} >= {1, 2, 3, 5, None}


def test_a_fixed_phrase_tells_though_its_words_have_one_neighbour(spark):
    """Toxic texts hold one phrase, ordinary ones as many rare words of their own."""
    rng = np.random.default_rng(8)
    rows = []
    for i in range(600):
        words = [f"w{j}" for j in rng.integers(0, 60, 40)]
        at = int(rng.integers(0, 40))
        words[at:at] = ["grim", "foul", "beast"] if i % 2 else [f"rare{i}x{k}" for k in range(3)]
        rows.append((i, " ".join(words), i % 2))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    found = toxicity.score(docs.drop("toxic"), toxicity.fit(docs.drop("toxic"), docs.select("doc_id", "toxic"))).toPandas().sort_values("doc_id")
    held = np.array([zlib.crc32(str(i).encode()) % 5 == 0 for i in range(600)])
    y = np.arange(600) % 2
    assert auc(found.score.to_numpy()[held], y[held]) > 0.99
    assert (found.score.to_numpy()[held & (y == 0)] >= 0.5).mean() < 0.02


def test_all_labelled_rows_are_counted(spark):
    """More rows of each label than were once drawn, each with a word of its own."""
    n = 24_000
    docs = spark.createDataFrame([(i, f"w{i % 7} own{i} w{i % 11}") for i in range(n)], "doc_id long, text string")
    marks = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    models = toxicity.fit(docs, marks)
    part = docs.select("doc_id", (toxicity.chance(F.col("doc_id"), 12) >= toxicity.TUNING).alias("counted")).collect()
    learned = [r.doc_id for r in part if r.counted and zlib.crc32(str(r.doc_id).encode()) % 5]
    own = Words(*texts(__import__("pyarrow").array([f"own{i}" for i in learned])))
    assert len(learned) > 15_000 and np.isin(own.hash, models.words).all() and len(models.words) == len(learned) + 11
    # Plain counts of distinct left neighbours, discounted in full, give the same weights.
    left = [{}, {}]
    for i in learned:
        words = ["", f"w{i % 7}", f"own{i}", f"w{i % 11}"]
        for a, b in zip(words, words[1:]):
            left[i % 2].setdefault(b, set()).add(a)
    names = sorted(left[0].keys() | left[1].keys())
    both = np.array([len(left[0].get(w, set()) | left[1].get(w, set())) for w in names])
    shared = (both + 0.5) / (both.sum() + 0.5 * len(both))
    gain = 0
    for sign, side in ((-1, left[0]), (1, left[1])):
        c = np.array([len(side.get(w, ())) for w in names])
        less = np.array([0, *toxicity.discounts([(c == k).sum() for k in (1, 2, 3, 4)])])
        kept = (c - less[np.minimum(c, 3)]) / c.sum()
        gain = gain + sign * np.log(kept + (1 - kept.sum()) * shared)
    at = np.searchsorted(models.words, Words(*texts(__import__("pyarrow").array(names))).hash)
    assert np.allclose(models.gain[at], gain)


def test_words_that_are_not_sent_count_too(spark):
    train = training_rows()
    # Rare words, copies and odd rows.
    docs = spark.createDataFrame([(i, f"{t} rare{i % 30}") for i, t in train] + ODD + [(300 + i, train[1][1]) for i in range(50)], "doc_id long, text string")
    marks = spark.createDataFrame([(i, i % 2) for i, _ in train], "doc_id long, toxic int")
    all_sent = toxicity.fit(docs, marks)
    assert all_sent.rest is None
    for bound in (0, 10):
        models = toxicity.fit(docs, marks, max_words=bound)
        assert len(models.words) <= bound and len(models.words) + models.rest.count() == len(all_sent.words)
        expected, got = ([sorted(map(repr, toxicity.score(docs, m).selectExpr("doc_id", "text", "round(score, 9)").collect()))] for m in (all_sent, models))
        assert got == expected


def test_evidence_is_the_largest_mean_of_a_run():
    rows = ["a b c d e", "", "c", "b c"]
    words = Words(*texts(__import__("pyarrow").array(rows)))
    known = np.argsort(words.hash[:5])
    models = toxicity.ClassModels(words.hash[:5][known], np.array([1.0, -2.0, 5.0, 1.0, 0.0])[known], 0.0, None, 0.5)
    got = models.evidence(words)
    assert got.tolist() == [[5, 3, 1.25, 1, 1], [0, 0, 0, 0, 0], [5, 5, 5, 5, 5], [5, 1.5, 1.5, 1.5, 1.5]]


def test_repeated_bytes_are_marked():
    data = np.frombuffer(b"abcdefgh" + b"xy z" * 8 + b"qrstuvw", np.uint8)
    marks = quality.repeats(data)
    expected = [any(all(j >= lag and data[j] == data[j - lag] for j in range(i - 15, i + 1)) for lag in range(1, 33)) if i >= 16 else False for i in range(len(data))]
    assert marks.tolist() == expected and marks.any()


def test_scores_do_not_depend_on_the_neighbours():
    network = quality.Network()
    rows = ["some text", "", "another, longer text " * 40, "z"]
    whole = network(*texts(__import__("pyarrow").array(rows)))
    alone = [network(*texts(__import__("pyarrow").array([r])))[0] for r in rows]
    assert np.allclose(whole, alone, atol=1e-6)
