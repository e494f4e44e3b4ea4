"""Small files and folders on any file system Spark reads, from the driver: for manifests and expired folders, never for rows."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Files:
    """What is under one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._hadoop = spark._jvm.org.apache.hadoop
        self._system = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._hadoop.fs.Path(f"{self.folder}/{name}" if name else self.folder)

    def names(self, name: str = "") -> list[str]:
        """Names inside a folder, in order; none if there is no such folder."""
        if not self._system.exists(self._path(name)):
            return []
        return sorted(s.getPath().getName() for s in self._system.listStatus(self._path(name)))

    def read_text(self, name: str) -> str:
        stream = self._system.open(self._path(name))
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_new(self, name: str, text: str) -> bool:
        """Write a file unless there is one of that name; says whether it was written."""
        try:
            stream = self._system.create(self._path(name), False)
        except Py4JJavaError as error:
            if self._system.exists(self._path(name)):
                return False
            raise error
        try:
            stream.write(text.encode())
        finally:
            stream.close()
        return True

    def delete(self, name: str) -> None:
        self._system.delete(self._path(name), True)
