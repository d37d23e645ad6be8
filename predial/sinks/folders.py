"""Folders and small files of the shared file system, by Hadoop's own client.

Everything goes through the file system that a path names, as Spark's reads and writes do, so
driver and executors see the same folders. Names and small files pass here, never tables.
"""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import SparkSession


class Folders:
    """The file system of a root, seen from the driver."""

    def __init__(self, spark: SparkSession, root: str):
        self._fs = spark._jvm.org.apache.hadoop.fs
        conf, path = spark._jsc.hadoopConfiguration(), self._fs.Path(root)
        self._files = path.getFileSystem(conf)
        # Only this interface renames without replacing what is there.
        self._context = self._fs.FileContext.getFileContext(self._files.getUri(), conf)
        kind = getattr(self._fs, "Options$Rename")
        self._no_options = spark.sparkContext._gateway.new_array(kind, 0)

    def _path(self, path: str):
        return self._files.makeQualified(self._fs.Path(path))

    def qualified(self, path: str) -> str:
        """The full address, without a slash at its end."""
        return self._path(path).toString().rstrip("/") if path else ""

    def exists(self, path: str) -> bool:
        return self._files.exists(self._path(path))

    def names(self, path: str) -> list[str]:
        """What a folder holds, sorted; nothing where there is no folder."""
        if not self.exists(path):
            return []
        return sorted(s.getPath().getName() for s in self._files.listStatus(self._path(path)))

    def create(self, path: str) -> None:
        self._files.mkdirs(self._path(path))

    def move(self, source: str, target: str) -> bool:
        """Rename; false, and nothing done, if the source is gone or the target is there.

        One step of the file system where that renames in one step (HDFS, local disks).
        """
        if not self.exists(source) or self.exists(target):
            return False
        try:
            self._context.rename(self._path(source), self._path(target), self._no_options)
        except Exception:
            if self.exists(source) and not self.exists(target):
                raise
            return False  # another run was faster
        return True

    def remove(self, path: str) -> None:
        self._files.delete(self._path(path), True)

    def remove_if_empty(self, path: str) -> None:
        if self.exists(path) and not self.names(path):
            self.remove(path)

    def read(self, path: str) -> Any:
        """A small JSON file."""
        size = self._files.getFileStatus(self._path(path)).getLen()
        stream = self._files.open(self._path(path))
        try:
            return json.loads(bytes(stream.readNBytes(int(size))).decode())
        finally:
            stream.close()

    def write(self, path: str, value: Any) -> None:
        stream = self._files.create(self._path(path), True)
        try:
            stream.write(bytearray(json.dumps(value).encode()))
        finally:
            stream.close()

    def age(self, path: str, now: str) -> float:
        """Seconds by which a file is older than another, by the file system's own clock."""
        times = [self._files.getFileStatus(self._path(p)).getModificationTime() for p in (path, now)]
        return (times[1] - times[0]) / 1000
