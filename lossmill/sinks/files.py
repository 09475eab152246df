"""Folders of a table, through the file system that its path names."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Files:
    """The few operations that swapping partitions and numbering versions need."""

    def __init__(self, spark: SparkSession):
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        p = self._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self._conf), p

    def exists(self, path: str) -> bool:
        fs, p = self._at(path)
        return fs.exists(p)

    def make(self, folder: str) -> None:
        fs, p = self._at(folder)
        fs.mkdirs(p)

    def delete(self, path: str) -> None:
        fs, p = self._at(path)
        fs.delete(p, True)

    def move(self, source: str, target: str) -> None:
        """Rename a folder to a name that is free in a folder that is there."""
        fs, new = self._at(target)
        if not fs.rename(self._at(source)[1], new):
            raise OSError(f"cannot move {source} to {target}")

    def names(self, folder: str) -> list[str]:
        fs, p = self._at(folder)
        return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []

    def missing_above(self, path: str) -> list[str]:
        """Parent folders that do not exist yet, the lowest first."""
        fs, p = self._at(path)
        found, parent = [], p.getParent()
        while parent is not None and not fs.exists(parent):
            found.append(parent.toString())
            parent = parent.getParent()
        return found

    def create_new(self, path: str) -> bool:
        """Create an empty file; false if it is there already. Of several that try at the same
        time one succeeds."""
        fs, p = self._at(path)
        fs.mkdirs(p.getParent())
        if fs.getScheme() == "file":
            return self._jvm.java.io.File(p.toUri().getPath()).createNewFile()
        try:
            fs.create(p, False).close()
        except Exception:
            if fs.exists(p):
                return False
            raise
        return True
