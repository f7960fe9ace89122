"""Table sinks."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from ..sources.tables import SourceSpec


@dataclass(frozen=True)
class SinkSpec(SourceSpec):
    """Where a table goes; ``partitions`` bounds the parallel connections."""

    partitions: int | None = field(default=None)

    @classmethod
    def of(cls, source: SourceSpec, partitions: int | None = None) -> SinkSpec:
        """The same place as a source spec, for writing."""
        return cls(source.format, source.options, source.path, None, source.secrets, partitions)


def write_table(df: DataFrame, spec: SinkSpec, mode: str = "overwrite") -> None:
    """Write ``df`` by the spec; ``mode='errorifexists'`` never replaces."""
    if spec.partitions is not None:
        df = df.coalesce(spec.partitions)
    writer = df.write.format(spec.format).options(**spec.options, **spec.secrets).mode(mode)
    writer.save(spec.path)
