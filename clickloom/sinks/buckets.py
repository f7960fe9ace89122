"""Tables bucketed and sorted by a key, so that joins and sums by it need no exchange.

The number of buckets is stored beside the data.  A table is known to the
session's catalog while it runs, under a name of its own that goes when Python
ends; the files stay.
"""

from __future__ import annotations

import atexit
import contextlib
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..functions.naming import quoted, sql_text
from ..paths import Directory

_NOTES = "_buckets.json"
_tables: list[tuple[SparkSession, str]] = []


def _fresh_name(spark: SparkSession) -> str:
    name = f"bucketed_{uuid.uuid4().hex}"
    if not _tables:
        atexit.register(_forget)
    _tables.append((spark, name))
    return name


def _forget() -> None:
    for spark, name in _tables:
        with contextlib.suppress(Exception):  # the session may have ended
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int) -> DataFrame:
    """Write ``df`` to the empty ``path`` in ``buckets`` files by ``key``, each sorted; returns the table.

    One exchange places every key once; later joins with tables of as many
    buckets reuse that.  The notes are written last, so a write that fails
    leaves no table.
    """
    spark = df.sparkSession
    target = Directory(spark, path)
    if target.exists():
        raise FileExistsError(f"{path} exists")
    # The exchange hashes as bucketing does: every task writes one bucket.
    placed = df.repartition(buckets, quoted(key)).write.format("parquet").option("path", path)
    name = _fresh_name(spark)
    placed.bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    notes = {"key": key, "buckets": buckets, "schema": df.schema.json()}
    target.write_text(_NOTES, json.dumps(notes))
    return spark.table(name)


def read_bucketed(spark: SparkSession, path: str) -> DataFrame:
    """A table of ``write_bucketed`` with its buckets, also in another session."""
    notes = json.loads(Directory(spark, path).read_text(_NOTES))
    fields = StructType.fromJson(json.loads(notes["schema"])).fields
    columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in fields)
    key, name = quoted(notes["key"]), _fresh_name(spark)
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet OPTIONS (path {sql_text(path)})"
        f" CLUSTERED BY ({key}) SORTED BY ({key}) INTO {notes['buckets']} BUCKETS"
    )
    return spark.table(name)
