"""Versioned folders: immutable parts and small manifests that name them.

::

    root/_data/<id>/...            what one write made; never changed
    root/_versions/<number>.json   version, its parts by name, and notes

A writer first writes a fresh folder under ``_data``, where executors commit
their files as they do anywhere, then publishes one manifest by one rename that
does not replace anything.  Nothing is moved and nothing overwritten, so a job
that dies at any moment leaves the last version as it was.  Readers take the
version with the highest number.  A part may name several folders, whose rows
belong together.  One writer at a time works on a root; a second one that
publishes the same number fails.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from .paths import Directory, join

DATA, VERSIONS = "_data", "_versions"
#: Digits of a version's name, so names sort as numbers do.
_DIGITS = 12

Parts = dict[str, list[str]]


@dataclass(frozen=True)
class Version:
    """One published state: folders by part name, relative to the root."""

    number: int = 0
    parts: Parts = field(default_factory=dict)
    notes: dict = field(default_factory=dict)


class VersionedFolder:
    """A root of immutable parts on any file system Spark can write to."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self._manifests = Directory(spark, join(root, VERSIONS))

    def numbers(self) -> list[int]:
        """Published versions that were not expired, ascending."""
        names = (name for name in self._manifests.files() if name.endswith(".json"))
        return sorted(int(stem) for name in names if (stem := name.removesuffix(".json")).isdigit())

    def at(self, number: int) -> Version:
        found = json.loads(self._manifests.read_text(f"{number:0{_DIGITS}}.json"))
        return Version(number, found["parts"], found["notes"])

    def latest(self) -> Version:
        """The newest version; number 0 without parts when there is none."""
        numbers = self.numbers()
        return self.at(numbers[-1]) if numbers else Version()

    def fresh(self) -> str:
        """Name of a new data folder, relative to the root; nothing reads it until it is published."""
        return join(DATA, uuid.uuid4().hex)

    def path(self, folder: str) -> str:
        return join(self.root, folder)

    def paths(self, version: Version, names: Iterable[str] | None = None) -> list[str]:
        """Folders of some parts of a version, or of all; a name it lacks has none."""
        chosen = version.parts if names is None else names
        return [self.path(f) for name in chosen for f in version.parts.get(name, [])]

    def publish(self, base: Version, parts: Parts, notes: Mapping | None = None) -> Version:
        """Make ``parts`` the version after ``base``; fails if another writer was first."""
        new = Version(base.number + 1, {k: list(v) for k, v in parts.items() if v}, dict(notes or {}))
        text = json.dumps({"parts": new.parts, "notes": new.notes}, sort_keys=True)
        draft = f"_draft-{uuid.uuid4().hex}"
        self._manifests.write_text(draft, text)
        self._manifests.rename_file(draft, f"{new.number:0{_DIGITS}}.json")
        return new

    def expire(self, keep: int = 1) -> list[str]:
        """Delete all but the newest ``keep`` versions, then the data no version names; returns that data.

        Manifests go first: a job that dies in between leaves data that the
        next call finds.  Data of a writer that died goes too, so no writer may
        be at work.
        """
        numbers = self.numbers()
        kept, gone = numbers[-keep:], numbers[:-keep]
        for number in gone:
            self._manifests.delete_file(f"{number:0{_DIGITS}}.json")
        for name in self._manifests.files():
            if name.startswith("_draft-"):
                self._manifests.delete_file(name)
        # The second step of a folder's name is the write it belongs to.
        used = {f.split("/")[1] for n in kept for folders in self.at(n).parts.values() for f in folders}
        data = Directory(self.spark, join(self.root, DATA))
        unused = [name for name in data.children() if name not in used]
        for name in unused:
            data.child(name).delete()
        return unused


def partition_folders(spark: SparkSession, root: str, folder: str, *columns: str) -> dict[tuple[str, ...], str]:
    """The partition folders of a finished write by their values: names only, no file is opened."""
    plain = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    found = {(): folder}
    for column in columns:
        deeper = {}
        for values, at in found.items():
            for name in Directory(spark, join(root, at)).children():
                key, _, value = name.partition("=")
                if key == column:
                    deeper[*values, plain(value)] = join(at, name)
        found = deeper
    return found
