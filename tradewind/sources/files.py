"""Folders and small files in whatever file system a path names, through Hadoop's own client."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Folder:
    """A path with its file system."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._files = self._path(self.path).getFileSystem(conf)

    def names(self, below: str = "") -> list[str]:
        """What lies in a folder; nothing if there is none."""
        path = self._path(f"{self.path}/{below}" if below else self.path)
        if not self._files.exists(path):
            return []
        return sorted(status.getPath().getName() for status in self._files.listStatus(path))

    def delete(self, below: str = "") -> None:
        path = self._path(f"{self.path}/{below}" if below else self.path)
        self._files.delete(path, True)

    def delete_at_exit(self) -> None:
        self._files.deleteOnExit(self._path(self.path))

    def read(self, name: str) -> str:
        """The text of a small file; empty if it has none."""
        row = self.spark.read.text(f"{self.path}/{name}", wholetext=True).first()
        return row[0] if row else ""

    def create(self, name: str, text: str) -> bool:
        """Make a small new file appear whole; False if there is one of that name.

        It is written under another name first, so that nobody sees a part of it, and what a
        crash leaves behind is in nobody's way.
        """
        target = self._path(f"{self.path}/{name}")
        part = self._path(target.getParent(), f".{uuid.uuid4().hex}.part")
        out = self._files.create(part, False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        if self._rename(part, target):
            return True
        self._files.delete(part, False)
        return False

    def _rename(self, part, target) -> bool:
        context = self.spark.sparkContext
        fs, conf = context._jvm.org.apache.hadoop.fs, context._jsc.hadoopConfiguration()
        kind = getattr(fs, "Options$Rename")
        options = context._gateway.new_array(kind, 1)
        options[0] = kind.NONE
        try:
            fs.FileContext.getFileContext(target.toUri(), conf).rename(part, target, options)
        except Py4JJavaError as error:
            if "AlreadyExists" in error.java_exception.getClass().getName():
                return False
            raise
        return True
