"""Versions of a set of tables in one shared folder, switched by one pointer (SNK-2).

    target/versions/<version>/<table>/        the table's files
    target/versions/<version>/_done/<table>   marker of a finished table, with its figures as JSON
    target/CURRENT                            name of the version that readers use

A table counts once its marker is renamed into place; CURRENT is replaced by one
rename when all tables are there. So a failed build leaves readers where
they were and its finished tables to the next attempt. Files are reached through
Spark's own file system layer, so any store that Spark can write will do.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession


class Folder:
    """The few file operations that a switch needs, on any store Spark reaches."""

    def __init__(self, spark: SparkSession, top: str):
        self.spark, self.top = spark, top.rstrip("/")
        self._jvm = spark._jvm
        self._context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            self._path(self.top).toUri(), spark._jsc.hadoopConfiguration())
        self._system = self._path(self.top).getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(name)

    def full(self, name: str) -> str:
        return f"{self.top}/{name}" if name else self.top

    def exists(self, name: str) -> bool:
        return self._system.exists(self._path(self.full(name)))

    def names(self, name: str) -> list[str]:
        if not self.exists(name):
            return []
        return sorted(s.getPath().getName() for s in self._system.listStatus(self._path(self.full(name))))

    def read(self, name: str) -> str | None:
        """A small file's text; None if there is none."""
        if not self.exists(name):
            return None
        path = self._path(self.full(name))
        stream = self._system.open(path)
        try:
            size = self._system.getFileStatus(path).getLen()
            return bytes(stream.readNBytes(int(size))).decode()
        finally:
            stream.close()

    def replace(self, name: str, text: str) -> None:
        """Write a small file beside its place and rename it there: readers see the old text or the new one."""
        part = self.full(f"{name}.{uuid.uuid4().hex}.part")
        stream = self._system.create(self._path(part), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        self._context.rename(self._path(part), self._path(self.full(name)), self._rename_option())

    def _rename_option(self):
        option = self._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        options = self.spark.sparkContext._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = option
        return options

    def remove(self, name: str) -> None:
        self._system.delete(self._path(self.full(name)), True)


class VersionedTables:
    """Tables that are written to a version and read from the current one."""

    def __init__(self, spark: SparkSession, target: str):
        self.spark, self.folder = spark, Folder(spark, target)

    def current(self) -> str | None:
        return self.folder.read("CURRENT")

    def versions(self) -> list[str]:
        return self.folder.names("versions")

    def unfinished(self) -> str | None:
        """The newest version begun after the current one."""
        current = self.current()
        return max((v for v in self.versions() if current is None or v > current), default=None)

    def path(self, version: str, table: str) -> str:
        return self.folder.full(f"versions/{version}/{table}")

    def done(self, version: str) -> dict[str, dict]:
        """Finished tables of a version, with what was noted of them."""
        top = f"versions/{version}/_done"
        return {t: json.loads(self.folder.read(f"{top}/{t}")) for t in self.folder.names(top) if not t.endswith(".part") and not t.startswith(".")}

    def finish(self, version: str, table: str, notes: dict) -> None:
        self.folder.replace(f"versions/{version}/_done/{table}", json.dumps(notes))

    def switch(self, version: str, tables: list[str]) -> None:
        """Make a version current; refused while one of its tables is missing."""
        missing = sorted(set(tables) - set(self.done(version)))
        if missing:
            raise RuntimeError(f"version {version} is not complete: {', '.join(missing)}")
        self.folder.replace("CURRENT", version)

    def read(self, version: str | None = None) -> dict[str, DataFrame]:
        """All finished tables of one version, the current one by default: the pointer is read once, so versions never mix."""
        version = version or self.current()
        if version is None:
            return {}
        return {t: self.spark.read.parquet(self.path(version, t)) for t in self.done(version)}

    def remove_superseded(self, keep: int = 1) -> list[str]:
        """Delete versions older than the current one, but for the last `keep` of them; names sort by age."""
        current = self.current()
        old = [v for v in self.versions() if current is not None and v < current]
        gone = old[:len(old) - keep] if keep else old
        for v in gone:
            self.folder.remove(f"versions/{v}")
        return gone
