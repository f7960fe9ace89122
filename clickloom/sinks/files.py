"""Text output of a ranked list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.naming import quoted


def write_ranked(df: DataFrame, path: str) -> None:
    """Tab-separated, no header, one file, rank order kept.

    ``df`` is sorted and limited, so it is one partition of at most k rows.
    Decimals are written out in full, never in exponent form.
    """
    columns = [
        F.col(quoted(f.name)).cast("string").alias(f.name)
        if isinstance(f.dataType, T.DecimalType)
        else F.col(quoted(f.name))
        for f in df.schema.fields
    ]
    df.select(*columns).coalesce(1).write.mode("overwrite").csv(
        path, sep="\t", header=False, quote="", escape=""
    )
