"""Small files and folders on any file system that Spark can reach."""

from __future__ import annotations

import posixpath
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Files:
    """The file system that holds ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self._context = spark.sparkContext
        self._hadoop = self._context._jvm.org.apache.hadoop.fs
        self._conf = self._context._jsc.hadoopConfiguration()
        self._system = self._hadoop.Path(path).getFileSystem(self._conf)

    def exists(self, path: str) -> bool:
        return self._system.exists(self._hadoop.Path(path))

    def names(self, folder: str) -> list[str]:
        """What is in a folder; nothing if there is no such folder."""
        if not self.exists(folder):
            return []
        return sorted(status.getPath().getName() for status in self._system.listStatus(self._hadoop.Path(folder)))

    def delete(self, path: str) -> None:
        self._system.delete(self._hadoop.Path(path), True)

    def put(self, path: str, text: str, replace: bool) -> bool:
        """Store a small text at once: readers see none of it or all.  False if it is there already and not replaced."""
        waiting = posixpath.join(posixpath.dirname(path), f".{uuid.uuid4().hex}")
        out = self._system.create(self._hadoop.Path(waiting), False)
        out.write(bytearray(text.encode()))
        out.close()
        options = self._context._gateway.new_array(self._hadoop.Options.Rename, int(replace))
        if replace:
            options[0] = self._hadoop.Options.Rename.OVERWRITE
        try:
            self._hadoop.FileContext.getFileContext(self._system.getUri(), self._conf).rename(
                self._hadoop.Path(waiting), self._hadoop.Path(path), options
            )
        except Py4JJavaError as error:
            self.delete(waiting)
            if "FileAlreadyExists" in str(error.java_exception.getClass().getName()):
                return False
            raise
        return True
