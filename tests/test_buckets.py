import random

import pytest
from pyspark.sql import functions as F

from clickloom.operators import count_long, count_vector, count_vector_sparse, to_dense, vocabulary
from clickloom.plans import feature_table
from clickloom.plans.features import read_feature_tables, write_feature_tables
from clickloom.operators import count_matrix
from clickloom.sinks.buckets import read_bucketed, write_bucketed


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_buckets_are_kept_for_the_next_session(spark, rows, tmp_path):
    df = spark.range(100).select(F.concat(F.lit("u'"), F.col("id")).alias("a.key"), F.array("id").alias("v"))
    path = str(tmp_path / "o'ne")
    written = write_bucketed(df, path, "a.key", 4)
    again = read_bucketed(spark, path)
    assert rows(written) == rows(again) == rows(df)
    assert again.dtypes == df.dtypes and len(set(again.inputFiles())) == 4
    assert "Exchange" not in plan_of(again.groupBy("`a.key`").count())
    with pytest.raises(FileExistsError):
        write_bucketed(df, path, "a.key", 4)


def test_a_failing_write_leaves_no_table(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(Exception, match="no"):
        write_bucketed(spark.range(3).select("id", F.raise_error(F.lit("no")).alias("x")), path, "id", 2)
    with pytest.raises(Exception):
        read_bucketed(spark, path)


def data(spark):
    rng = random.Random(4)
    visits = [(f"u{rng.randrange(30)}", 1577836800000 + rng.randrange(10**9), rng.choice(["a.ru", "b.ru", "c.ru", None])) for _ in range(400)]
    items = [(f"u{rng.randrange(40)}", f"i{rng.randrange(6)}") for _ in range(300)]
    return spark.createDataFrame(visits, "uid string, timestamp bigint, domain string"), spark.createDataFrame(items, "uid string, item_id string")


def test_feature_table_without_an_exchange(spark, rows, tmp_path):
    visits, items = data(spark)
    write_feature_tables(count_long(items, "uid", "item_id"), visits, str(tmp_path / "t"), 2, buckets=3)
    joined = read_feature_tables(spark, str(tmp_path / "t"))
    expected = feature_table(count_matrix(items, "uid", "item_id"), visits, 2)
    assert joined.columns == expected.columns and rows(joined) == rows(expected)
    plan = plan_of(joined)
    assert "Exchange" not in plan and plan.count("SortMergeJoin") >= 2
    sparse = read_feature_tables(spark, str(tmp_path / "t"), dense=False)
    assert rows(to_dense(sparse)) == rows(expected)


@pytest.mark.parametrize("broadcast_bytes", [0, 1 << 20])
@pytest.mark.parametrize("element_type", ["int", "bigint", "double"])
def test_sparse_vectors_are_the_dense_ones(spark, rows, broadcast_bytes, element_type):
    visits, _ = data(spark)
    visits = visits.unionByName(spark.createDataFrame([("none", 0, None), ("far", 0, "z.ru"), (None, 0, "a.ru")], visits.schema))
    for vocab in (vocabulary(visits, "domain"), ["b.ru"], ["0", "b.ru", "zz"], []):
        options = {"element_type": element_type, "broadcast_bytes": broadcast_bytes}
        dense = count_vector(visits, "uid", "domain", vocab, **options)
        sparse = count_vector_sparse(visits, "uid", "domain", vocab, **options)
        assert rows(to_dense(sparse)) == rows(dense) and to_dense(sparse).dtypes == dense.dtypes
        for uid, (size, indices, values) in ((r[0], r[1]) for r in sparse.collect()):
            assert size == len(vocab) and indices == sorted(set(indices)) and all(values) and len(values) == len(indices)
