"""Feature table: users x items joined with web-visit features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.urls import domain_of
from ..operators.features import (
    count_vector,
    count_vector_sparse,
    feature_matrix,
    time_features,
    to_dense,
    vocabulary,
)
from ..operators.mart import explode_visits
from ..operators.matrix import count_map, distinct_values, to_wide
from ..sinks.buckets import read_bucketed, write_bucketed
from ..sources.files import read_user_visits
from ..sources.paths import Directory, join, pinned, scratch_dir
from ..sources.snapshots import read_snapshot, read_snapshot_counts

TOP_DOMAINS = 1000


def visit_domains(weblogs: DataFrame, strip: str = "anywhere") -> DataFrame:
    """Visits as ``(uid, timestamp, domain)``, host in lower case."""
    return explode_visits(weblogs).select(
        "uid", "timestamp", domain_of(F.col("url"), strip=strip, lower=True).alias("domain")
    )


def pinned_visits(weblogs: DataFrame, path: str) -> DataFrame:
    """``visit_domains`` as a pinned table.

    Vocabulary, vectors and time features each pass over the visits; this way
    the nested log is parsed once.
    """
    return pinned(visit_domains(weblogs), path)


def feature_table(users_items: DataFrame, visits: DataFrame, n: int = TOP_DOMAINS) -> DataFrame:
    """Join the matrix with domain vectors and time features of ``visits``."""
    vectors = count_vector(visits, "uid", "domain", vocabulary(visits, "domain", n))
    return feature_matrix(users_items, vectors, time_features(visits))


def write_feature_tables(
    counts: DataFrame, visits: DataFrame, path: str, n: int = TOP_DOMAINS, buckets: int | None = None
) -> None:
    """Long counts, vectors and time features of users as tables bucketed by ``uid`` under ``path``.

    Each user's rows are placed once, here.  Tables written apart, on different
    days even, join without an exchange as long as ``buckets`` is the same; by
    default it is the number of shuffle partitions.  Vectors are kept sparse.
    """
    spark = counts.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    vectors = count_vector_sparse(visits, "uid", "domain", vocabulary(visits, "domain", n))
    tables = {"counts": counts, "vectors": vectors, "times": time_features(visits)}
    for name, table in tables.items():
        write_bucketed(table, join(path, name), "uid", buckets)


def read_feature_tables(spark: SparkSession, path: str, dense: bool = True) -> DataFrame:
    """``feature_table`` from the bucketed tables, by two merge joins in place."""
    counts, vectors, times = (
        read_bucketed(spark, join(path, name)) for name in ("counts", "vectors", "times")
    )
    values = distinct_values(counts, "item_id")
    matrix = to_wide(counts, "uid", "item_id", values, gathered=True)
    # A hint, as a small table would be sent everywhere where none needs to move.
    return feature_matrix(matrix, (to_dense(vectors) if dense else vectors).hint("merge"), times.hint("merge"))


def build_features(
    spark: SparkSession,
    weblogs_path: str,
    users_items_dir: str,
    date: str,
    output: str,
    n: int = TOP_DOMAINS,
    wide: bool = True,
) -> None:
    """Read the log and one matrix snapshot, write the feature table.

    With ``wide`` off the counts come as one map ``items``, from the long form.
    """
    scratch = scratch_dir(spark)
    try:
        visits = pinned_visits(read_user_visits(spark, weblogs_path), scratch)
        if wide:
            users_items = read_snapshot(spark, users_items_dir, date)
        else:
            counts = read_snapshot_counts(spark, users_items_dir, date, "uid", "item_id")
            users_items = count_map(counts, "uid", "item_id")
        table = feature_table(users_items, visits, n)
        table.write.mode("overwrite").parquet(output)
    finally:
        Directory(spark, scratch).delete()
