"""Small-file access through the Hadoop file system of a path (local, HDFS, object stores)."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Folder:
    def __init__(self, spark: SparkSession, root: str):
        self.root = root.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def path(self, *parts: object) -> str:
        return "/".join([self.root, *map(str, parts)])

    def _resolve(self, *parts: object):
        path = self._jvm.org.apache.hadoop.fs.Path(self.path(*parts))
        return path.getFileSystem(self._conf), path

    def exists(self, *parts: object) -> bool:
        fs, path = self._resolve(*parts)
        return fs.exists(path)

    def names(self, *parts: object) -> list[str]:
        fs, path = self._resolve(*parts)
        if not fs.exists(path):
            return []
        return sorted(status.getPath().getName() for status in fs.listStatus(path))

    def read_text(self, *parts: object) -> str:
        fs, path = self._resolve(*parts)
        stream = fs.open(path)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def publish_text(self, text: str, *parts: object) -> None:
        """Write under a temporary name, then rename: readers see all of it or nothing."""
        fs, path = self._resolve(*parts)
        draft = self._jvm.org.apache.hadoop.fs.Path(path.getParent(), f".{path.getName()}.draft")
        stream = fs.create(draft, True)
        try:
            stream.write(bytearray(text.encode("utf-8")))
        finally:
            stream.close()
        if not fs.rename(draft, path):
            raise FileExistsError(f"could not publish {self.path(*parts)}")

    def move(self, source: tuple, target: tuple) -> None:
        """Rename a folder; the target must not exist."""
        fs, path = self._resolve(*source)
        _, goal = self._resolve(*target)
        fs.mkdirs(goal.getParent())
        if not fs.rename(path, goal):
            raise FileExistsError(f"could not move to {self.path(*target)}")

    def delete(self, *parts: object) -> None:
        fs, path = self._resolve(*parts)
        fs.delete(path, True)
