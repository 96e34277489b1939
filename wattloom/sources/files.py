"""Folders and small files on any file system that Spark can reach, seen from the driver."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Folder:
    """A folder; paths are relative to it.  It is for names and small records, never for rows."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._root = self._at("")
        self._fs = self._root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def exists(self, name: str = "") -> bool:
        return self._fs.exists(self._at(name))

    def names(self, name: str = "") -> list[str]:
        """What lies in a folder, in order; nothing if there is no such folder."""
        return sorted(f.getPath().getName() for f in self._fs.listStatus(self._at(name))) if self.exists(name) else []

    def partitions(self, name: str, depth: int) -> list[str]:
        """The name=value folders of a partitioned table, `depth` levels down."""
        found = [""]
        for _ in range(depth):
            found = [f"{f}/{n}".lstrip("/") for f in found for n in self.names(f"{name}/{f}".rstrip("/")) if "=" in n]
        return found

    def create(self, name: str, text: str) -> bool:
        """Write a new small file; False if it is there already, which is left as it is.

        On HDFS and the like, of several writers only one succeeds.
        """
        try:
            out = self._fs.create(self._at(name), False)
        except Py4JJavaError as e:
            if "FileAlreadyExists" in e.java_exception.getClass().getName() or self.exists(name):
                return False
            raise
        out.write(bytearray(text.encode()))
        out.close()
        return True

    def read(self, name: str) -> str:
        stream = self._fs.open(self._at(name))
        try:
            return bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()

    def move(self, name: str, other: str) -> bool:
        """Rename within the file system; other is a whole path, whose parents are made."""
        to = self._jvm.org.apache.hadoop.fs.Path(other)
        self._fs.mkdirs(to.getParent())
        return self._fs.rename(self._at(name), to)

    def delete(self, name: str = "") -> None:
        self._fs.delete(self._at(name), True)
