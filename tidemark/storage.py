"""Folders of the store that tables live in, through Hadoop's file system, whatever store it is."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Folders:
    """Existence, names, moves and removal of folders; paths as Spark's readers take them."""

    def __init__(self, spark: SparkSession):
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        target = self._jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self._conf), target

    def exists(self, path: str) -> bool:
        fs, target = self._at(path)
        return fs.exists(target)

    def names(self, path: str) -> list[str]:
        """Names of the folders in a folder, none if it does not exist."""
        fs, target = self._at(path)
        if not fs.exists(target):
            return []
        return sorted(s.getPath().getName() for s in fs.listStatus(target) if s.isDirectory())

    def files(self, path: str) -> list[str]:
        """Names of the files in a folder."""
        fs, target = self._at(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(target) if s.isFile())

    def mark(self, path: str) -> None:
        """An empty file; to create one is atomic."""
        fs, target = self._at(path)
        fs.create(target, True).close()

    def remove(self, path: str) -> None:
        fs, target = self._at(path)
        fs.delete(target, True)

    def move(self, path: str, to: str) -> None:
        """Move a folder to where nothing is left."""
        fs, target = self._at(path)
        _, end = self._at(to)
        fs.delete(end, True)
        fs.mkdirs(end.getParent())
        if not fs.rename(target, end):
            raise OSError(f"cannot move {path} to {to}")
