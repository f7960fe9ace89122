"""Profile mart from four stores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.mart import profile_mart, shop_categories, web_category_matrix
from ..operators.matrix import count_long, distinct_values, to_wide
from ..sinks.tables import SinkSpec, write_table
from ..sources.paths import Directory, join, pinned, scratch_dir
from ..sources.tables import SourceSpec, read_table


def shop_matrix(visits: DataFrame, scratch: str) -> DataFrame:
    """Shop category matrix that reads the store once.

    The column names depend on the data.  They come from the pinned counts,
    not from a second pass over the store.
    """
    counts = pinned(count_long(shop_categories(visits), "uid", "cat"), join(scratch, "shop"))
    return to_wide(counts, "uid", "cat", distinct_values(counts, "cat"))


def build_mart(
    spark: SparkSession,
    clients: SourceSpec,
    visits: SourceSpec,
    weblogs: SourceSpec,
    categories: SourceSpec,
    sink: SinkSpec,
    mode: str = "overwrite",
) -> None:
    """Read the four stores, join them into the mart and write it."""
    scratch = scratch_dir(spark)
    try:
        # The category table is read for names, size and join; keep one copy.
        named = pinned(read_table(spark, categories), join(scratch, "categories"))
        mart = profile_mart(
            read_table(spark, clients),
            shop_matrix(read_table(spark, visits), scratch),
            web_category_matrix(read_table(spark, weblogs), named),
        )
        write_table(mart, sink, mode)
    finally:
        Directory(spark, scratch).delete()
