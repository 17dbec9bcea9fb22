"""Single files beside the tables, through the file systems that Spark itself uses: any path it reads or writes."""

from __future__ import annotations

import json
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


class Files:
    """Read, write, move and delete on the driver; a missing file is told from one that can't be reached."""

    def __init__(self, spark: SparkSession) -> None:
        self.jvm = spark.sparkContext._jvm
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):
        where = self.jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.conf), where

    def exists(self, path: str) -> bool:
        fs, where = self._at(path)
        return fs.exists(where)

    def size(self, path: str) -> int:
        fs, where = self._at(path)
        return fs.getFileStatus(where).getLen()

    def free(self, path: str) -> int:
        """Bytes free where a folder is or will be."""
        fs, where = self._at(path)
        fs.mkdirs(where)
        return fs.getStatus(where).getRemaining()

    def delete(self, path: str) -> None:
        fs, where = self._at(path)
        fs.delete(where, True)

    def rename(self, path: str, to: str) -> None:
        fs, where = self._at(path)
        target = self.jvm.org.apache.hadoop.fs.Path(to)
        fs.delete(target, False)
        if not fs.rename(where, target):
            raise OSError(f"{path} can't be renamed to {to}")

    def read(self, path: str, offset: int = 0, size: int | None = None) -> bytes:
        """A file, or a part of it."""
        fs, where = self._at(path)
        source = fs.open(where)
        try:
            source.seek(offset)
            tools = self.jvm.org.apache.commons.io.IOUtils
            return bytes(tools.toByteArray(source) if size is None else tools.toByteArray(source, size))
        finally:
            source.close()

    @contextmanager
    def writing(self, path: str) -> Iterator:
        """A put(bytes) for a new file, which appears under its name once all is written."""
        fs, where = self._at(f"{path}.part")
        sink = fs.create(where, True)
        try:
            yield lambda content: sink.write(bytearray(content))
        except BaseException:
            sink.close()
            fs.delete(where, False)
            raise
        sink.close()
        self.rename(f"{path}.part", path)

    def copy(self, source: str, target: str, head: bytes = b"") -> int:
        """Head and a file's content as a new file, complete or not there; returns its size.  Bytes stay in the JVM."""
        from_fs, from_path = self._at(source)
        to_fs, to_path = self._at(f"{target}.part")
        reader, sink = from_fs.open(from_path), to_fs.create(to_path, True)
        try:
            if head:
                sink.write(bytearray(head))
            self.jvm.org.apache.hadoop.io.IOUtils.copyBytes(reader, sink, 1 << 20, False)
        finally:
            reader.close()
            sink.close()
        size = to_fs.getFileStatus(to_path).getLen()
        declared = from_fs.getFileStatus(from_path).getLen()
        if declared >= 0 and size != declared + len(head):
            to_fs.delete(to_path, False)
            raise OSError(f"{source}: {size - len(head)} of {declared} bytes came")
        self.rename(f"{target}.part", target)
        return size

    def fetched(self, url: str, folder: str) -> str:
        """The local copy of a url of any file system that Spark knows: what is there and not empty is not fetched again."""
        name = url.partition("://")[2] or url
        for c in "/\\:":
            name = name.replace(c, "_")
        target = f"{folder}/{name}"
        if not self.exists(target) or not self.size(target):
            self.copy(url, target)
        return target

    def read_json(self, path: str, default=None):
        if default is not None and not self.exists(path):
            return default
        return json.loads(self.read(path))

    def write_json(self, path: str, value) -> None:
        with self.writing(path) as put:
            put(json.dumps(value).encode())
