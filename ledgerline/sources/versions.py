"""Tables stored as immutable state versions (SK6, SK8): one publisher for every load."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .files import Files

VERSION_PREFIX = "v="
TAG_PREFIX = "_tag."


class VersionedTable:
    """A table stored as state versions ``base/v=NNNNNNNNNN[.tag]``.

    Readers take the newest version whose ``_SUCCESS`` marker exists.  Writers
    that build a state upon the one before use :meth:`commit`, which never loses
    another writer's version; :meth:`publish` writes a version whose number the
    caller chose.  A tag names who wrote the version (a stream's checkpoint and
    epoch), so that a replayed batch finds the version it wrote before.  Works
    on any Hadoop file system.
    """

    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base.rstrip("/")
        self.files = Files(spark)

    def _entries(self) -> list[tuple[int, str]]:
        """(version, directory name) of every complete version, oldest first."""
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.base)
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(path):
            return []
        out = []
        for st in fs.listStatus(path):
            name = st.getPath().getName()
            number = name[len(VERSION_PREFIX):].split(".")[0]
            if st.isDirectory() and name.startswith(VERSION_PREFIX) and number.isdigit() \
                    and fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
                out.append((int(number), name))
        return sorted(out)

    def versions(self) -> list[int]:
        return sorted({v for v, _ in self._entries()})

    def read(self, version: int) -> DataFrame:
        name = [n for v, n in self._entries() if v == version][-1]
        return self.spark.read.parquet(f"{self.base}/{name}")

    def latest(self) -> DataFrame | None:
        v = self.versions()
        return self.read(v[-1]) if v else None

    def _written_by(self, tag: str) -> list[int]:
        """Versions that carry the tag, in their name or in a marker file."""
        return [v for v, n in self._entries() if n.endswith(f".{tag}") or self.files.exists(f"{self.base}/{n}/{TAG_PREFIX}{tag}")]

    def version_for(self, tag: str) -> tuple[int, int | None]:
        """(version to write, version before it) for a tagged writer: the version
        the tag wrote before if there is one, else the next."""
        entries = self._entries()
        mine = self._written_by(tag)
        version = mine[0] if mine else (entries[-1][0] + 1 if entries else 0)
        before = [v for v, _ in entries if v < version]
        return version, before[-1] if before else None

    def publish(self, df: DataFrame, version: int, partition_by: list[str] | None = None, tag: str = "") -> str:
        """Write one complete state; Spark's commit protocol adds ``_SUCCESS``
        only when every task succeeded, so a failed load leaves the version
        before it in place.  ``partition_by`` (e.g. a date column) lets later
        scans prune whole directories."""
        path = f"{self.base}/{VERSION_PREFIX}{version:010d}" + (f".{tag}" if tag else "")
        w = df.write.mode("overwrite")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(path)
        return path

    def commit(self, build: Callable[[DataFrame | None], DataFrame], partition_by: list[str] | None = None, tag: str = "", first: int = 0) -> int:
        """Publish ``build(newest state or None)`` as the version after that state.

        The state is written where no reader looks and then claims its version
        number, which succeeds only while nobody else has it.  A writer that
        comes second reads the newer state, builds again and tries the next
        number; so two loads at a time both end up in the table.  A tag that has
        published before (a replayed batch) publishes nothing.  ``first`` is the
        number of a table's first version.
        """
        while True:
            entries = self._entries()
            if tag and (mine := self._written_by(tag)):
                return mine[0]
            version = entries[-1][0] + 1 if entries else first
            staged = f"{self.base}/_staged/{uuid.uuid4().hex}"
            current = self.spark.read.parquet(f"{self.base}/{entries[-1][1]}") if entries else None
            w = build(current).write
            (w.partitionBy(*partition_by) if partition_by else w).parquet(staged)
            if tag:
                self.files.write(f"{staged}/{TAG_PREFIX}{tag}", "")
            # a version published under its own tag counts as taken too
            taken = any(v >= version for v, _ in self._entries())
            if not taken and self.files.claim(staged, f"{self.base}/{VERSION_PREFIX}{version:010d}"):
                return version
            self.files.delete(staged)
