import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from clickloom.llm import toxicity
from clickloom.llm.common import read

from .test_contamination import brute as passages
from .test_exact import brute as copies
from .test_similar import brute as near

SF = "/root/testdata/sf0.001"


def test_run_equals_plain_stages(spark):
    docs = read(spark, SF, "documents")
    score = toxicity.score(docs, toxicity.fit(docs, read(spark, SF, "labels")))
    rows = [(r.doc_id, r.text) for r in score.where(F.col("score") < 0.5).collect()]
    assert 0 < len(rows) <= docs.count()
    kept = {i for i, _, _, stays in copies(rows) if stays}
    rows = [r for r in rows if r[0] in kept]
    classes = near(rows)
    rows = [r for r in rows if classes[r[0]][0] == r[0]]
    hits = passages(rows, [(r.item_id, r.text) for r in read(spark, SF, "benchmark").collect()])
    rows = [r for r in rows if not hits[r[0]][1]]
    got = corpus_pipeline.run(spark, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(i for i, _ in rows)
    assert all(r.parity and r.round_trip for r in got)


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_take_odd_rows(spark, name, stage):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, "a", "en", "s", 1), (3, "a", "en", "s", 1), (None, "b c", None, "s", 3), (4, "w " * 50_000, "en", "s", 100_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("score", F.lit("x"))
    out = stage(spark, docs, SF)
    if name != corpus_pipeline.STAGES[-1][0]:
        assert out.columns == docs.columns
    assert {r.doc_id for r in out.collect()} >= {2, 3, 4, None}
    assert stage(spark, docs.limit(0), SF).collect() == []
