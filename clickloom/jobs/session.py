"""Session of a submitted job; every setting comes from ``spark-submit``."""

from __future__ import annotations

from pyspark.sql import SparkSession


def job_session(name: str) -> SparkSession:
    return SparkSession.builder.appName(name).getOrCreate()
