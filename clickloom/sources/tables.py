"""One connector facade: where a table lives is data, not code."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .. import schemas


@dataclass(frozen=True)
class SourceSpec:
    """Format, options and optional path of a table.

    ``secrets`` are options that never show up in a printed spec.
    """

    format: str
    options: dict[str, str] = field(default_factory=dict)
    path: str | None = None
    schema: T.StructType | None = None
    secrets: dict[str, str] = field(default_factory=dict, repr=False)


def read_table(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    """Load the table; filters and column choices reach the source if it can."""
    reader = spark.read.format(spec.format).options(**spec.options, **spec.secrets)
    if spec.schema is not None:
        reader = reader.schema(spec.schema)
    return reader.load(spec.path)


def json_files(path: str, schema: T.StructType = schemas.USER_VISITS) -> SourceSpec:
    return SourceSpec("json", path=path, schema=schema)


def search_index(index: str, nodes: str, **options: str) -> SourceSpec:
    """Document index, read in parallel by shard."""
    return SourceSpec("org.elasticsearch.spark.sql", {"es.nodes": nodes, **options}, path=index)


def wide_column(
    keyspace: str, table: str, host: str, port: int = 9042, **options: str
) -> SourceSpec:
    """Wide-column table, read in parallel by token range."""
    connection = {
        "spark.cassandra.connection.host": host,
        "spark.cassandra.connection.port": str(port),
        "spark.cassandra.input.consistency.level": "ONE",
        "spark.cassandra.output.consistency.level": "ANY",
    }
    return SourceSpec(
        "org.apache.spark.sql.cassandra",
        {"keyspace": keyspace, "table": table, **connection, **options},
    )


def relational(
    url: str,
    table: str,
    driver: str = "org.postgresql.Driver",
    user: str | None = None,
    password: str | None = None,
    partition: tuple[str, int, int, int] | None = None,
    **options: str,
) -> SourceSpec:
    """Table of a relational store.

    ``partition`` is ``(column, lower, upper, count)``: without it the store is
    read by one task, which suits dimension tables only.
    """
    chosen = {"url": url, "dbtable": table, "driver": driver, **options}
    if partition is not None:
        column, lower, upper, count = partition
        chosen.update(
            partitionColumn=column,
            lowerBound=str(lower),
            upperBound=str(upper),
            numPartitions=str(count),
        )
    login = {"user": user, "password": password}
    return SourceSpec("jdbc", chosen, secrets={k: v for k, v in login.items() if v is not None})
