"""Publishing written tables: aside first, then partition by partition.

A publication writes its tables to a folder of its own beside the published ones. Only when
all are written do the new partitions take the places of the old ones, by renaming folders;
partitions the run was asked for that have no rows any more are taken away, all others stay.
If a step fails, the folders moved so far are moved back, so readers keep the old tables. Runs
for different regions may publish to the same place one after the other or at once.

Folders of running publications begin with a dot, which readers skip. What is moved is
the partition's folder, so the cost does not depend on its size on file systems that
rename; on object stores a rename copies.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from urllib.parse import unquote
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

#: Whether a partition, as values by column, belongs to what a run replaces.
Covers = Callable[[Mapping[str, str]], bool]


class Publication:
    """Tables on their way to ``path/<name>``; ``add`` writes one, ``publish`` shows all."""

    def __init__(self, spark: SparkSession, path: str):
        context = spark.sparkContext
        self._place = context._jvm.org.apache.hadoop.fs.Path
        self.path = path.rstrip("/")
        self.aside = f"{self.path}/.publishing-{uuid4().hex}"
        self._files = self._place(self.path).getFileSystem(context._jsc.hadoopConfiguration())
        self._tables: dict[str, tuple[str, ...]] = {}
        self._moved: list[tuple[str, str]] = []

    def add(
        self, name: str, table: DataFrame, partitions: tuple[str, ...], fmt: str, **options: str
    ) -> str:
        """Write a table aside; returns the folder it will be published to."""
        writer = table.write.partitionBy(*partitions).format(fmt).options(**options)
        writer.save(f"{self.aside}/new/{name}")
        self._tables[name] = partitions
        return f"{self.path}/{name}"

    def publish(self, covers: Covers = lambda partition: True) -> None:
        """Replace the partitions that ``covers`` accepts, in all tables, or in none."""
        try:
            for name, partitions in self._tables.items():
                self._swap(name, partitions, covers)
        except BaseException:
            for source, target in reversed(self._moved):
                self._files.rename(self._place(target), self._place(source))
            self.discard()
            raise
        self.discard()

    def discard(self) -> None:
        self._files.delete(self._place(self.aside), True)

    def _swap(self, name: str, partitions: tuple[str, ...], covers: Covers) -> None:
        new = self._partitions(f"{self.aside}/new/{name}", len(partitions))
        old = self._partitions(f"{self.path}/{name}", len(partitions))
        self._files.mkdirs(self._place(f"{self.path}/{name}"))
        for folder in sorted(old):
            if folder in new or covers(_values(folder)):
                self._move(f"{self.path}/{name}/{folder}", f"{self.aside}/old/{name}/{folder}")
        # A first-level folder that is not there yet moves as a whole.
        there = {folder.split("/")[0] for folder in old}
        for folder in sorted({f if (top := f.split("/")[0]) in there else top for f in new}):
            self._move(f"{self.aside}/new/{name}/{folder}", f"{self.path}/{name}/{folder}")

    def _partitions(self, folder: str, depth: int) -> set[str]:
        """Partition folders below ``folder``, such as ``a=1/b=2``."""
        found = {""}
        for _ in range(depth):
            found = {f"{p}/{own}".lstrip("/") for p in found for own in self._folders(f"{folder}/{p}")}
        return found

    def _folders(self, folder: str) -> list[str]:
        place = self._place(folder.rstrip("/"))
        if not self._files.exists(place):
            return []
        entries = [e for e in self._files.listStatus(place) if e.isDirectory()]
        return [n for e in entries if "=" in (n := e.getPath().getName()) and n[0] not in "._"]

    def _move(self, source: str, target: str) -> None:
        self._files.mkdirs(self._place(target).getParent())
        if not self._files.rename(self._place(source), self._place(target)):
            raise OSError(f"{source} could not be moved to {target}")
        self._moved.append((source, target))


def _values(folder: str) -> dict[str, str]:
    """The partition values of a folder; Spark writes special characters as %XX."""
    parts = (part.split("=", 1) for part in folder.split("/"))
    return {unquote(name): unquote(value) for name, value in parts}
