"""File-system metadata calls through the session's Hadoop client.

Listing, renaming and deleting directories only: no file content passes
through the driver, and any file system Spark can write to works.
"""

from __future__ import annotations

import atexit
import contextlib
import uuid

from pyspark.sql import DataFrame, SparkSession


def join(*parts: str) -> str:
    return "/".join([parts[0].rstrip("/"), *[p.strip("/") for p in parts[1:]]])


class Directory:
    """One directory on the file system that its path names."""

    def __init__(self, spark: SparkSession, path: str):
        self._spark = spark
        self._path = spark._jvm.org.apache.hadoop.fs.Path(path)
        self._fs = self._path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
        self.path = path

    def exists(self) -> bool:
        return self._fs.exists(self._path)

    def children(self) -> list[str]:
        """Names of the sub-directories."""
        if not self.exists():
            return []
        return [
            s.getPath().getName() for s in self._fs.listStatus(self._path) if s.isDirectory()
        ]

    def has_files(self, suffix: str) -> bool:
        """Whether a file with this ending lies directly here."""
        return self.exists() and any(
            s.isFile() and s.getPath().getName().endswith(suffix)
            for s in self._fs.listStatus(self._path)
        )

    def files(self) -> list[str]:
        """Names of the files directly here."""
        if not self.exists():
            return []
        return [s.getPath().getName() for s in self._fs.listStatus(self._path) if s.isFile()]

    def _file(self, name: str):
        return self._spark._jvm.org.apache.hadoop.fs.Path(self._path, name)

    def read_text(self, name: str) -> str:
        """A small file of notes, whole."""
        stream = self._fs.open(self._file(name))
        try:
            return self._spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_text(self, name: str, text: str) -> None:
        stream = self._fs.create(self._file(name), True)
        try:
            stream.write(text.encode())
        finally:
            stream.close()

    def rename_file(self, name: str, new: str) -> None:
        """Rename a file here; never onto one that is there."""
        if self._fs.exists(self._file(new)) or not self._fs.rename(self._file(name), self._file(new)):
            raise FileExistsError(f"{join(self.path, new)} exists or cannot be written")

    def delete_file(self, name: str) -> None:
        self._fs.delete(self._file(name), False)

    def child(self, name: str) -> Directory:
        return Directory(self._spark, join(self.path, name))

    def create(self) -> None:
        self._fs.mkdirs(self._path)

    def delete(self) -> None:
        self._fs.delete(self._path, True)

    def move_to(self, target: Directory) -> None:
        self._fs.mkdirs(target._path.getParent())
        if not self._fs.rename(self._path, target._path):
            raise OSError(f"cannot rename {self.path} to {target.path}")

    def replace(self, target: Directory) -> None:
        """Put this directory in the place of ``target``.

        The old content is set aside first and deleted last, so a job that
        dies in between has lost nothing.
        """
        aside = Directory(self._spark, _sibling(target.path, f"_old-{uuid.uuid4().hex}"))
        if not target.exists():
            self.move_to(target)
            return
        target.move_to(aside)
        try:
            self.move_to(target)
        except Exception:
            aside.move_to(target)
            raise
        aside.delete()


def recover(spark: SparkSession, parent: str) -> None:
    """Finish or undo what a writer that died left under ``parent``.

    Content that was set aside goes back where its place is empty, else it is
    out of date and deleted.  Writers call this first; one writer at a time may
    work on a directory.
    """
    for name in Directory(spark, parent).children():
        if name.startswith("_old-"):
            aside = Directory(spark, join(parent, name))
            own = name.removeprefix("_old-").partition("-")[2]
            target = Directory(spark, join(parent, own))
            if target.exists():
                aside.delete()
            else:
                aside.move_to(target)


def _sibling(path: str, name: str) -> str:
    parent, _, own = path.rstrip("/").rpartition("/")
    hidden = f"{name}-{own}"
    return f"{parent}/{hidden}" if parent else (f"/{hidden}" if path.startswith("/") else hidden)


def staging(spark: SparkSession, parent: str) -> Directory:
    """A fresh hidden directory beside the output, on the same file system."""
    return Directory(spark, join(parent, f"_staging-{uuid.uuid4().hex}"))


def scratch_dir(spark: SparkSession) -> str:
    """A fresh directory for intermediate tables that all executors reach.

    It lies in the folder the cluster names in ``spark.checkpoint.dir``.  Only
    a local session without that setting falls back to its warehouse.  A result
    may read it lazily, so what is not deleted before goes when Python ends.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        base = spark.conf.get("spark.sql.warehouse.dir")
    path = join(base, f"clickloom-{uuid.uuid4().hex}")
    if not _scratch:
        atexit.register(_delete_scratch)
    _scratch.append((spark, path))
    return path


_scratch: list[tuple[SparkSession, str]] = []


def _delete_scratch() -> None:
    for spark, path in _scratch:
        with contextlib.suppress(Exception):  # the session may have ended
            Directory(spark, path).delete()


def pinned(df: DataFrame, path: str) -> DataFrame:
    """``df`` written as a columnar table under ``path`` and read back.

    Later steps do not repeat the work behind it, and a lost executor costs a
    re-read only.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
