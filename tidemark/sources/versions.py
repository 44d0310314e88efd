"""Versions of a table, found through small numbered files beside the data.

A writer puts data into a folder that nobody reads yet and then adds the next numbered file, which names the folders that make the
table from now on. A reader takes the file of the highest number. So any session that knows the location finds the current version, never sees
half a write, and stays whole while later versions are written. A number can be taken once only: of two writers one fails.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import SparkSession

__all__ = ["VersionLog"]


@dataclass(frozen=True)
class VersionLog:
    spark: SparkSession
    location: str

    def folder(self, label: str) -> str:
        """Name of a folder that no one has used."""
        return f"{label}-{uuid.uuid4().hex[:12]}"

    def path(self, name: str) -> str:
        return f"{self.location.rstrip('/')}/{name}"

    def _hadoop(self, name: str):
        context = self.spark.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(self.path(name))
        return path, path.getFileSystem(context._jsc.hadoopConfiguration())

    def _numbers(self) -> list[int]:
        path, files = self._hadoop("_versions")
        if not files.exists(path):
            return []
        names = (status.getPath().getName() for status in files.listStatus(path))
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0].isdigit())

    def latest(self) -> tuple[int, dict] | None:
        """Number and content of the current state; None before the first one."""
        numbers = self._numbers()
        if not numbers:
            return None
        path, files = self._hadoop(f"_versions/{numbers[-1]:020d}.json")
        stream = files.open(path)
        try:
            text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return numbers[-1], json.loads(text)

    def add(self, number: int, state: dict) -> None:
        """Makes ``state`` the current one; fails if another writer has taken the number."""
        context = self.spark.sparkContext
        hidden, files = self._hadoop(f"_versions/_{uuid.uuid4().hex}")
        final, _ = self._hadoop(f"_versions/{number:020d}.json")
        out = files.create(hidden, False)
        out.write(bytearray(json.dumps(state).encode()))
        out.close()
        jvm = context._jvm
        # unlike FileSystem.rename this never replaces a file
        rename = jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), context._jsc.hadoopConfiguration()).rename
        rename(hidden, final, context._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))

    def forget(self, folders: Iterable[str], before: int) -> None:
        """Deletes folders of data and the files of states numbered below ``before``."""
        for name in [*folders, *(f"_versions/{n:020d}.json" for n in self._numbers() if n < before)]:
            path, files = self._hadoop(name)
            files.delete(path, True)
