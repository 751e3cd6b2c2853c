"""Small files on any file system that Spark knows, seen from the driver."""

from __future__ import annotations

from uuid import uuid4

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Folder:
    """Files of a folder. ``add`` is the one way to write, and never replaces anything."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.gateway = spark._jvm, spark.sparkContext._gateway
        self.root = self.jvm.org.apache.hadoop.fs.Path(path)
        self.conf = spark._jsparkSession.sessionState().newHadoopConf()
        self.files = self.root.getFileSystem(self.conf)

    def _at(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(self.root, name)

    def ages(self) -> dict[str, float]:
        """Seconds since each entry changed; empty where there is no folder."""
        if not self.files.exists(self.root):
            return {}
        now = self.jvm.java.lang.System.currentTimeMillis()
        return {entry.getPath().getName(): (now - entry.getModificationTime()) / 1000 for entry in self.files.listStatus(self.root)}

    def names(self) -> list[str]:
        return sorted(self.ages())

    def text(self, name: str) -> str:
        stream = self.files.open(self._at(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def add(self, name: str, text: str) -> bool:
        """Add a file as a whole; false, and no change, if there is one of that name.

        The text is written aside and then renamed, which fails where the name is taken.
        """
        self.files.mkdirs(self.root)
        aside = self._at(f"_{uuid4().hex}")
        stream = self.files.create(aside, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.root.toUri(), self.conf)
        kind = getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename")
        try:
            context.rename(aside, self._at(name), self.gateway.new_array(kind, 0))
        except Py4JJavaError as error:
            self.files.delete(aside, False)
            if error.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
                return False
            raise
        return True

    def remove(self, name: str = "") -> None:
        """Delete an entry, or the folder itself, with all it holds."""
        self.files.delete(self._at(name) if name else self.root, True)
