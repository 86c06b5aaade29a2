"""Versioned manifests: many tables become visible with one small file.

Writers put data under folders that nobody reads yet and then commit a
manifest, ``v000000001.json`` and so on, that names them.  Readers take the
newest complete manifest, so they see all tables of one version or of the one
before, never a mixture.  Everything goes through the Hadoop file system of
the folder; a manifest is created exclusively, so of two writers that start
from one version the second fails and changes nothing.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession


class Conflict(RuntimeError):
    """Another writer has committed the next version already."""


class Manifests:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.jvm = spark.sparkContext._jvm
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")

    def file_system(self):
        return self.path("x").getFileSystem(self.conf)

    def names(self) -> list[str]:
        """Entries of the folder."""
        fs, top = self.file_system(), self.jvm.org.apache.hadoop.fs.Path(self.folder)
        return [s.getPath().getName() for s in fs.listStatus(top)] if fs.exists(top) else []

    def _read(self, name: str) -> dict | None:
        stream = self.file_system().open(self.path(name))
        try:
            text = self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        try:
            return json.loads(text)
        except ValueError:  # its writer was stopped before the end
            return None

    def latest(self) -> tuple[int, dict]:
        """Number and content of the newest complete manifest; (0, {}) if none."""
        for name in sorted((n for n in self.names() if n.startswith("v") and n.endswith(".json")), reverse=True):
            content = self._read(name)
            if content is not None:
                return int(name[1:-5]), content
        return 0, {}

    def commit(self, version: int, content: dict) -> int:
        """Write the manifest after ``version`` (what the work began from)."""
        taken = max([0, *(int(n[1:-5]) for n in self.names() if n.startswith("v") and n.endswith(".json"))])
        if self.latest()[0] != version:
            raise Conflict(f"{self.folder}: version {version} is no longer the newest")
        # A torn manifest keeps its number; the next one is above it.
        number = max(version, taken) + 1
        target = self.path(f"v{number:09d}.json")
        try:
            out = self.file_system().create(target, False)
        except Exception as e:  # the file exists
            raise Conflict(f"{self.folder}: version {number} was committed meanwhile") from e
        try:
            out.write(bytearray(json.dumps(content), "utf-8"))
        finally:
            out.close()
        return number

    def drop(self, name: str) -> None:
        self.file_system().delete(self.path(name), True)
