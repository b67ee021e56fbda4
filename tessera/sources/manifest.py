"""Listing of the given tables' files on the driver (SRC-1).

A folder is listed through the session's own file system (local, HDFS, an
object store, viewfs), at most once for each manifest and without a Spark job.
Nothing is read from the files.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import SparkSession

from .tables import table_path


class InputManifest:
    """Paths, sizes and times of the files under the tables of ``sf_dir``; one manifest serves one query build."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._dir = spark, sf_dir
        self._files: dict[str, list[tuple[str, int, int]]] = {}

    def files(self, table: str) -> list[tuple[str, int, int]]:
        """(path, length, modification time) of the table's files, those that Spark's readers see."""
        if table not in self._files:
            jvm = self._spark.sparkContext._jvm
            path = jvm.org.apache.hadoop.fs.Path(table_path(self._dir, table))
            fs = path.getFileSystem(self._spark._jsparkSession.sessionState().newHadoopConf())
            found = self._below(fs, fs.getFileStatus(path)) if fs.exists(path) else ()
            self._files[table] = sorted(found)
        return self._files[table]

    def identity(self, tables: tuple[str, ...]) -> str:
        """Changes when a file of the tables is added, removed or rewritten."""
        digest = hashlib.sha256()
        for table in tables:
            digest.update(repr(self.files(table)).encode())
        return digest.hexdigest()

    def _below(self, fs, status) -> Iterator[tuple[str, int, int]]:
        if not status.isDirectory():
            yield status.getPath().toString(), status.getLen(), status.getModificationTime()
            return
        for inner in fs.listStatus(status.getPath()):
            if not inner.getPath().getName().startswith(("_", ".")):
                yield from self._below(fs, inner)
