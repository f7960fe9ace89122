import random
import re

from clickloom.llm.contamination import drop_contaminated, find_passages

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items):
    windows = {}
    for i, text in items:
        w = words(text)
        n = min(10, len(w))
        for s in range(len(w) - n + 1) if n else ():
            windows.setdefault(tuple(w[s : s + n]), set()).add("" if i is None else str(i))
    sizes = {len(w) for w in windows}
    out = {}
    for i, text in docs:
        w = words(text)
        hit, found = [False] * len(w), set()
        for n in sizes:
            for s in range(len(w) - n + 1):
                if tuple(w[s : s + n]) in windows:
                    hit[s : s + n] = [True] * n
                    found |= windows[tuple(w[s : s + n])]
        out[i] = len(w), sum(hit), tuple(sorted(found))
    return out


def result(df):
    out = {}
    for r in df.collect():
        spans = list(zip(r.hit_spans[::2], r.hit_spans[1::2]))
        assert sum(b - a for a, b in spans) == r.n_hit
        assert all(a < b for a, b in spans) and all(x[1] < y[0] for x, y in zip(spans, spans[1:]))
        out[r.doc_id] = r.n_words, r.n_hit, tuple(r.hit_items)
    return out


def cases():
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(4)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([0, 1, 3, 7, 9, 10, 12, 30])))) for i in range(25)]
    items += [(3, "Another row of item three, with enough words to be one more window"), (None, "no id but a text of its own"), (90, None), (91, "é ß " * 6)]
    docs = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(0, 40)))) for i in range(40)]
    docs += [(100, None), (101, ""), (102, "x " + "No ID, but a text of its own!" * 2), (103, "é ß " * 20), (104, " . ")]
    docs += [(105, "z " * 60_000 + "w1 w2 w3")]
    return docs, items


def test_matches_all_windows(spark):
    docs, items = cases()
    d = spark.createDataFrame([(*r, "old", 1) for r in docs], "doc_id long, text string, n_hit string, id int")
    b = spark.createDataFrame(items, "item_id long, text string")
    expected = brute(docs, items)
    assert result(find_passages(d, b)) == expected
    # Many blocks of the benchmark give the same.
    assert result(find_passages(d, b, block_bytes=200)) == expected
    assert result(find_passages(d.limit(0), b)) == {}
    assert all(v[1:] == (0, ()) for v in result(find_passages(d, b.limit(0))).values())


def test_long_items_only(spark):
    rng = random.Random(1)
    items = [(i, " ".join(f"b{rng.randrange(500)}" for _ in range(40))) for i in range(10)]
    docs = []
    for i in range(60):
        text = [f"d{rng.randrange(500)}" for _ in range(80)]
        if i % 2:
            start, n = rng.randrange(30), rng.choice([9, 10, 11, 25])
            text[20 : 20 + n] = items[i % 10][1].split()[start : start + n]
        docs.append((i, " ".join(text)))
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert result(find_passages(d, b)) == brute(docs, items)


def test_clean_documents_stay_with_their_columns(spark):
    docs, items = cases()
    d = spark.createDataFrame([(*r, i, 5) for i, r in enumerate([*docs, docs[-1]])], "doc_id long, text string, n_hit int, n_words int")
    b = spark.createDataFrame(items, "item_id long, text string")
    left = drop_contaminated(d, b)
    assert left.columns == d.columns
    expected = brute(docs, items)
    assert sorted((r.doc_id, r.n_hit) for r in left.collect()) == sorted((r[0], i) for i, r in enumerate([*docs, docs[-1]]) if not expected[r[0]][1])
