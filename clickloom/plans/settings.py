"""Typed job options from the session configuration."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import SparkSession

REQUIRED = object()

Option = tuple[Callable[[str], Any], Any]


def job_conf(spark: SparkSession, prefix: str, options: dict[str, Option]) -> dict[str, Any]:
    """Read ``prefix.name`` for each option ``name: (type, default)``.

    A default of ``REQUIRED`` makes a missing option an error.
    """
    found = {}
    for name, (convert, default) in options.items():
        raw = spark.conf.get(f"{prefix}.{name}", None)
        if raw is None:
            if default is REQUIRED:
                raise ValueError(f"missing option {prefix}.{name}")
            found[name] = default
        else:
            found[name] = convert(raw)
    return found
