"""Folders of marks: small facts about tables, kept as empty files beside them."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Folder:
    """A folder, through the file system of its path."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark.sparkContext._jvm
        self._path = self._jvm.org.apache.hadoop.fs.Path(path)
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._system = self._path.getFileSystem(conf)

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(self._path, name)

    def names(self) -> list[str]:
        if not self._system.exists(self._path):
            return []
        return [status.getPath().getName() for status in self._system.listStatus(self._path)]

    def touch(self, name: str) -> None:
        self._system.create(self._at(name), True).close()

    def claim(self, name: str) -> bool:
        """Create a file that no one has created before; False if someone has."""
        try:
            self._system.create(self._at(name), False).close()
        except Py4JJavaError:
            if self._system.exists(self._at(name)):
                return False
            raise
        return True

    def claim_next(self, prefix: str = "", start: int = 0) -> int:
        """The first number from `start` on that no one has claimed, claimed now."""
        number = start
        while not self.claim(f"{prefix}{number}"):
            number += 1
        return number

    def remove(self, name: str) -> None:
        self._system.delete(self._at(name), True)


def numbers(spark: SparkSession, path: str) -> list[int]:
    """The numbers that a folder of marks holds, ascending."""
    return sorted(map(int, Folder(spark, path).names()))
