"""The few file-system calls the driver makes, on whatever file system Spark uses."""

from __future__ import annotations

from uuid import uuid4

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Folder:
    """A small folder, such as a commit log, or a landing batch."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._jvm, self._gateway = spark._jvm, spark.sparkContext._gateway
        self._path = self._jvm.org.apache.hadoop.fs.Path(path)
        self._fs = self._path.getFileSystem(spark._jsc.hadoopConfiguration())

    @property
    def path(self) -> str:
        """The full path, as file scans spell it."""
        return self._fs.makeQualified(self._path).toString()

    def names(self) -> list[str]:
        if not self._fs.exists(self._path):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._path))

    def _child(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(self._path, name)

    def read(self, name: str) -> str:
        stream = self._fs.open(self._child(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def first_line(self) -> str:
        """First line of this file, or of the first data file in this folder."""
        for status in sorted(self._fs.listStatus(self._path), key=lambda s: s.getPath().getName()):
            if status.getPath().getName()[0] in "._" or status.getLen() == 0:
                continue
            stream = self._fs.open(status.getPath())
            codec = self._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(self._fs.getConf()).getCodec(status.getPath())
            try:
                stream = codec.createInputStream(stream) if codec else stream
                reader = self._jvm.java.io.InputStreamReader(stream, "UTF-8")
                return self._jvm.java.io.BufferedReader(reader).readLine() or ""
            finally:
                stream.close()
        return ""

    def move(self, path: str) -> None:
        """Move a file or folder into this folder."""
        self._fs.mkdirs(self._path)
        source = self._jvm.org.apache.hadoop.fs.Path(path)
        if not self._fs.rename(source, self._child(source.getName())):
            raise RuntimeError(f"could not move {path} to {self.path}")

    def create(self, name: str, text: str) -> None:
        """Write a new file in one step; fails if the name is taken."""
        draft = self._child(f".{name}.{uuid4().hex}")
        stream = self._fs.create(draft, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        try:
            self._claim(draft, self._child(name))
        except Py4JJavaError as error:
            raise RuntimeError(f"{name} was committed by another writer") from error
        finally:
            self._fs.delete(draft, False)

    def _claim(self, draft, target) -> None:
        """Give a file its final name, in one step that fails when the name is taken."""
        if self._fs.getScheme() == "file":
            old, new = (self._jvm.java.io.File(p.toUri().getPath()).toPath() for p in (draft, target))
            self._jvm.java.nio.file.Files.createLink(new, old)
            return
        hadoop = self._jvm.org.apache.hadoop.fs
        context = hadoop.FileContext.getFileContext(self._fs.getUri(), self._fs.getConf())
        # Without the option to overwrite, a rename refuses an existing target.
        kind = getattr(hadoop, "Options$Rename")
        options = self._gateway.new_array(kind, 1)
        options[0] = kind.NONE
        context.rename(draft, target, options)
