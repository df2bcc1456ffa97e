"""Folder operations that plain Parquet tables need, on whatever file system a path names."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Files:
    """All paths have to lie on the file system of the first one."""

    def __init__(self, spark: SparkSession, path: str):
        jvm = self._jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def glob(self, pattern: str) -> list[str]:
        found = self._fs.globStatus(self._path(pattern))
        return [] if found is None else [status.getPath().toString() for status in found]

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def existing(self, paths: list[str]) -> list[str]:
        return [path for path in paths if self.exists(path)]

    def size(self, path: str) -> int:
        return self._fs.getContentSummary(self._path(path)).getLength()

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def move(self, source: str, target: str) -> None:
        """Within one folder tree; the target's parents are made."""
        self._fs.mkdirs(self._path(target).getParent())
        if not self._fs.rename(self._path(source), self._path(target)):
            raise OSError(f"cannot move {source} to {target}")

    def write_text(self, path: str, text: str) -> None:
        """A small file, complete under its name or not there at all."""
        folder, name = path.rsplit("/", 1)
        draft = self._path(f"{folder}/_{name}")
        stream = self._fs.create(draft, True)
        stream.write(bytearray(text.encode()))
        stream.close()
        self._fs.delete(self._path(path), False)
        self.move(f"{folder}/_{name}", path)

    def read_text(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
