"""A file topic of revisions, kept small by levelled compaction.

Each micro-batch adds a run at level 0.  As soon as a level has ``FAN`` runs they
become one run of the next level, which keeps the last revision of every key.
After ``n`` batches there are fewer than ``FAN`` runs on each of about
``log(n) / log(FAN)`` levels, and every row was written again once a level.  Runs
are immutable and named by a manifest, so readers see a whole batch or nothing
of it, before and after a compaction alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.topics import TopicSpec
from ..versions import Version, VersionedFolder

FAN = 8
#: Versions that stay readable after a compaction.
KEEP = 32

SCHEMA = "key string, value string, topic string, revision bigint"
_QUERY = "sql.streaming.queryId"


def _name(level: int, first: int, last: int) -> str:
    return f"{level}/{first:012d}-{last:012d}"


def _runs(version: Version, level: int) -> list[str]:
    return sorted(name for name in version.parts if name.startswith(f"{level}/"))


def _bounds(name: str) -> tuple[int, int]:
    first, last = name.partition("/")[2].split("-")
    return int(first), int(last)


class RevisionLog:
    """Levelled runs of messages; of a key (a field of the JSON value) the last revision counts."""

    def __init__(self, spark: SparkSession, spec: TopicSpec, key: str, fan: int = FAN, keep: int = KEEP):
        if fan < 2:
            raise ValueError("fan is 2 at least")
        self.store = VersionedFolder(spark, spec.path)
        self.spec, self.key, self.fan, self.keep = spec, key, fan, keep

    def append(self, batch: DataFrame, batch_id: int) -> None:
        """Add one micro-batch; one that runs again after it was published adds nothing.

        The stream is told from an earlier one by its query id: after a lost
        checkpoint batches count from 0 again, and are newer all the same.
        """
        base = self.store.latest()
        query = batch.sparkSession.sparkContext.getLocalProperty(_QUERY) or ""
        if base.notes.get("query") == query and batch_id <= base.notes["batch"]:
            return
        revision = base.notes.get("revision", -1) + 1
        key: Column = F.get_json_object("value", f"$.{self.key}")
        topic = F.col("topic") if "topic" in batch.columns else F.lit(self.spec.name)
        rows = batch.select(key.alias("key"), "value", topic.cast("string").alias("topic"), F.lit(revision).cast("bigint").alias("revision"))
        folder = self._write(rows)
        notes = {"query": query, "batch": batch_id, "revision": revision}
        self._compact(self.store.publish(base, base.parts | {_name(0, revision, revision): [folder]}, notes))

    def _write(self, rows: DataFrame) -> str:
        folder = self.store.fresh()
        # As many files as the size asks for, most often one.
        rows.hint("rebalance").write.format(self.spec.format).options(**self.spec.options).save(self.store.path(folder))
        return folder

    def _compact(self, version: Version) -> None:
        level, merged = 0, False
        while len(runs := _runs(version, level)) >= self.fan:
            rows = self._read(version, runs)
            row = F.struct("value", "topic", "revision")
            last = rows.groupBy("key").agg(F.max_by(row, "revision").alias("last")).select("key", "last.*")
            name = _name(level + 1, _bounds(runs[0])[0], _bounds(runs[-1])[1])
            left = {k: v for k, v in version.parts.items() if k not in runs}
            version = self.store.publish(version, left | {name: [self._write(last)]}, version.notes)
            level, merged = level + 1, True
        if merged:
            self.store.expire(self.keep)

    def _read(self, version: Version, runs: list[str] | None = None) -> DataFrame:
        spark, paths = self.store.spark, self.store.paths(version, runs)
        if not paths:
            return spark.createDataFrame([], SCHEMA)
        return spark.read.format(self.spec.format).options(**self.spec.options).schema(SCHEMA).load(paths)

    def read(self) -> DataFrame:
        """``(value, revision)`` of the runs: of every key the last revision and perhaps earlier ones."""
        return self._read(self.store.latest()).select("value", "revision")
