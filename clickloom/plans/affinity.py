"""Domains most typical for a user segment."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.affinity import segment_affinity, valid_log_rows
from ..sinks.files import write_ranked
from ..sources.files import read_segment, read_weblog


def rank_domains(
    spark: SparkSession,
    log_path: str,
    segment_path: str,
    output: str,
    k: int = 200,
    multi_line: bool = False,
) -> DataFrame:
    """Rank the domains of a web log for a segment and write the list.

    ``multi_line`` reads a segment document that spans several lines.  A
    segment without ids has no ranking and is an error.
    """
    log = valid_log_rows(read_weblog(spark, log_path))
    segment = read_segment(spark, segment_path, multi_line=multi_line)
    if segment.isEmpty():
        raise ValueError(f"no user ids in {segment_path}; does the document span several lines?")
    ranked = segment_affinity(log, segment, "domain", k)
    write_ranked(ranked, output)
    return ranked
