"""Control of running streaming queries."""

from __future__ import annotations

from pyspark.sql import SparkSession


def stop_streams(spark: SparkSession) -> list[str]:
    """Stop every active query; returns what each one was reading."""
    stopped = []
    for query in spark.streams.active:
        progress = query.lastProgress
        sources = progress["sources"] if progress else []
        query.stop()
        stopped.append(sources[0]["description"] if sources else str(query.id))
    return stopped
