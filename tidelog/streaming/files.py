"""Folders of the shared file system, by the file system Spark itself uses."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Files:
    spark: SparkSession

    def _at(self, path: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()), where

    def exists(self, path: str) -> bool:
        fs, where = self._at(path)
        return fs.exists(where)

    def children(self, folder: str) -> list[str]:
        """Names in a folder, hidden ones left out; none where it doesn't exist."""
        fs, where = self._at(folder)
        if not fs.exists(where):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(where)]
        return sorted(n for n in names if n[0] not in "._")

    def is_written(self, folder: str) -> bool:
        """Whether a job that wrote the folder was committed: its part files appear then."""
        return any(n.startswith("part-") for n in self.children(folder))

    def delete(self, path: str) -> None:
        fs, where = self._at(path)
        fs.delete(where, True)

    def make(self, folder: str) -> None:
        fs, where = self._at(folder)
        fs.mkdirs(where)

    def replace(self, source: str, target: str) -> None:
        """Put a file in the place of another. Cut short between the two steps, the source is
        still there and the call can be repeated."""
        fs, new = self._at(source)
        old = self.spark._jvm.org.apache.hadoop.fs.Path(target)
        fs.delete(old, False)
        if not fs.rename(new, old):
            raise OSError(f"can't move {source} to {target}")
