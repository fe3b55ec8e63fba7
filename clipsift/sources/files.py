"""Small files and folders in any store that Spark reaches."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class Folder:
    """Names, markers and small texts below ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._place = spark._jvm.org.apache.hadoop.fs.Path
        self._files = self._place(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def path(self, name: str = ""):
        return self._place(f"{self.root}/{name}" if name else self.root)

    def make(self) -> None:
        self._files.mkdirs(self.path())

    def on_disk(self) -> str | None:
        """The folder as a path of the operating system; None in any other store."""
        uri = self._files.makeQualified(self.path()).toUri()
        return uri.getPath() if uri.getScheme() == "file" else None

    def exists(self, name: str = "") -> bool:
        return self._files.exists(self.path(name))

    def names(self, name: str = "") -> list[str]:
        """Sorted names in a folder; none if it is not there."""
        if not self.exists(name):
            return []
        return sorted(s.getPath().getName() for s in self._files.listStatus(self.path(name)))

    def partitions(self, column: str) -> list[str]:
        """Values of a table's first partition column, as its folders spell them."""
        return [n.split("=", 1)[1] for n in self.names() if n.startswith(f"{column}=")]

    def create(self, name: str, text: str) -> None:
        """Write a file that must not be there yet."""
        out = self._files.create(self.path(name), False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def replace(self, name: str, text: str) -> None:
        """Write a file beside its place and move it there."""
        fresh = f"{name}.new-{uuid.uuid4().hex}"
        self.create(fresh, text)
        if self.exists(name):
            self.delete(name)
        if not self._files.rename(self.path(fresh), self.path(name)):
            raise OSError(f"cannot move {self.root}/{fresh}")

    def read(self, name: str) -> str:
        rows = self.spark.read.text(f"{self.root}/{name}", wholetext=True).collect()  # one small file
        return rows[0][0] if rows else ""

    def delete(self, name: str) -> None:
        self._files.delete(self.path(name), True)
