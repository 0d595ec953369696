"""Small files of a table's log on any file system Hadoop knows, written by the driver."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class Folder:
    """A folder of small text files."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self._gateway = spark.sparkContext._gateway
        self.path = path
        self._fs = self._at().getFileSystem(self._conf)
        self._fs.mkdirs(self._at())

    def _at(self, name: str = ""):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self) -> list[str]:
        """Names of the files and folders in it, in order; hidden ones are left out."""
        found = (status.getPath().getName() for status in self._fs.listStatus(self._at()))
        return sorted(name for name in found if not name.startswith((".", "_SUCCESS")))

    def modified(self, name: str) -> float:
        """Seconds since 1970."""
        return self._fs.getFileStatus(self._at(name)).getModificationTime() / 1000

    def read(self, name: str) -> str:
        stream = self._fs.open(self._at(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """Writes a file that isn't there yet, whole or not at all; False if somebody else was first.

        The text goes to a hidden file, which is then given the name. Renaming without overwriting is exclusive on HDFS; in a
        local folder a hard link is, and a rename isn't.
        """
        hidden, target = self._at(f".{uuid.uuid4().hex}"), self._at(name)
        stream = self._fs.create(hidden, False)
        stream.write(bytearray(text, "utf-8"))
        stream.close()
        try:
            if self._fs.getScheme() == "file":
                files, paths = self._jvm.java.nio.file.Files, self._jvm.java.nio.file.Paths
                files.createLink(paths.get(target.toUri().getPath(), self._gateway.new_array(self._jvm.String, 0)),
                                 paths.get(hidden.toUri().getPath(), self._gateway.new_array(self._jvm.String, 0)))
            else:
                hadoop = self._jvm.org.apache.hadoop.fs
                context = hadoop.FileContext.getFileContext(self._fs.makeQualified(target).toUri(), self._conf)
                context.rename(hidden, target, self._gateway.new_array(getattr(hadoop, "Options$Rename"), 0))
            return True
        except Exception:
            if self._fs.exists(target):
                return False
            raise
        finally:
            self._fs.delete(hidden, False)

    def remove(self, name: str) -> None:
        self._fs.delete(self._at(name), True)
