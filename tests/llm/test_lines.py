import random

from clickloom.llm.lines import LineRuns, drop_repeated_lines, line_key

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(LOWER)


def brute(rows, least=10):
    holders = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            holders.setdefault(key(line), []).append(i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(key(x)) < least or min(holders[key(x)]) == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out)


def result(df):
    return sorted((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in df.collect())


def test_lines_over_batches(spark):
    rng = random.Random(2)
    pool = [f"  Line number {i} \t" for i in range(12)] + ["short", "ÄÖÜÄÖÜÄÖÜ", "ÄÖÜÄÖÜÄÖÜß", "", "Line number 3"]
    rows = [(i, "\n".join(rng.choices(pool, k=rng.randint(0, 6)))) for i in rng.sample(range(1000), 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for batches in (1, 3, 9):
        assert result(drop_repeated_lines(docs, batches=batches)) == brute(rows)


def test_odd_rows(spark):
    shared = "A line that documents share"
    rows = [(3, None), (4, ""), (5, shared), (6, f"{shared}\r\n{shared}\nown words of six"), (7, "x" * 100_000 + "\n" + shared.upper()), (9, "\n\n")]
    docs = spark.createDataFrame([(*r, "old", 3) for r in rows], "doc_id long, text string, h string, n_lines int")
    assert result(drop_repeated_lines(docs)) == brute(rows)
    assert result(drop_repeated_lines(docs.limit(0))) == []
    twice = spark.createDataFrame([(2, shared), (2, shared), (None, shared), (8, None)], "doc_id long, text string")
    got = {(r.doc_id, r.n_dropped, r.text) for r in drop_repeated_lines(twice).collect()}
    assert got == {(2, 1, ""), (None, 0, shared), (8, 0, "")}


def test_runs_are_compacted_and_keep_the_smallest_owner(spark):
    runs = LineRuns(spark, buckets=2, fanout=2)
    try:
        for batch in range(5):
            pairs = [(bytes([k]) * 16, 10 * batch + k) for k in range(batch, batch + 4)]
            runs.add(spark.createDataFrame(pairs, "h binary, doc_id long"))
            assert all(len(level) < 2 for level in runs.levels)
        owners = {bytes(r.h)[0]: r.owner for r in runs.owners().collect()}
        assert owners == {k: (k if k < 4 else 10 * (k - 3) + k) for k in range(8)}
    finally:
        runs.drop()


def test_keys_count_code_points():
    assert line_key("ÄÖÜÄÖÜÄÖÜ".encode(), 10) is None
    assert line_key(" ABCdefghij\r".encode(), 10) == line_key(b"abcdefghij", 10)
    assert line_key("É234567890".encode(), 10) != line_key("é234567890".encode(), 10)
