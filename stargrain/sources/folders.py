"""Small files and folders on whatever file system a path names, through Spark's Hadoop client."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Folders:
    """List, read, write and delete below a root; for log lines and folders, never for table rows."""

    def __init__(self, spark: SparkSession, root: str):
        self.root = root.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._fs = self._path("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def exists(self, name: str) -> bool:
        return self._fs.exists(self._path(name))

    def names(self, name: str = "") -> list[str]:
        """Names in a folder, sorted; none if there is no such folder. Any other failure is raised."""
        if not self.exists(name):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._path(name)))

    def read_text(self, name: str) -> str:
        stream = self._fs.open(self._path(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create_text(self, name: str, text: str) -> None:
        """Write a new file whole; fails if it exists, so that of two writers one loses."""
        draft = self._path(f"{name}.draft-{self._jvm.java.util.UUID.randomUUID().toString()}")
        stream = self._fs.create(draft, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        target = self._path(name)
        if self._fs.exists(target) or not self._fs.rename(draft, target):
            self._fs.delete(draft, False)
            raise FileExistsError(f"{name} was written by somebody else")

    def delete(self, name: str) -> bool:
        return self._fs.delete(self._path(name), True)
