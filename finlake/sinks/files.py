"""Small file-system helpers on Hadoop's FileSystem (local, HDFS, object stores).

Only names and a few bytes pass through the driver, never table rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Files:
    """The file system of one folder."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark.sparkContext._jvm
        self.root = root.rstrip("/")
        self._fs = self.path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(name)

    def exists(self, name: str) -> bool:
        return bool(self._fs.exists(self.path(name)))

    def folders(self, name: str) -> list[str]:
        """Names of the sub-folders of ``name`` (none when it does not exist)."""
        return [n for n, folder in self._entries(name) if folder]

    def names(self, name: str) -> list[str]:
        """Names of the plain files directly in ``name``."""
        return [n for n, folder in self._entries(name) if not folder]

    def _entries(self, name: str) -> Iterator[tuple[str, bool]]:
        try:
            entries = self._fs.listStatusIterator(self.path(name))
            while entries.hasNext():
                e = entries.next()
                yield e.getPath().getName(), bool(e.isDirectory())
        except Py4JJavaError as e:
            if not _is_missing(e):
                raise

    def data_files(self, name: str) -> Iterator[str]:
        """Relative names of the table files under ``name``; hidden ones (``_``, ``.``) are left out."""
        folders = [""]
        while folders:
            at = folders.pop()
            for n, folder in self._entries(f"{name}/{at}" if at else name):
                if n.startswith(".") or n.startswith("_") and "=" not in n:
                    continue
                if folder:
                    folders.append(f"{at}/{n}" if at else n)
                else:
                    yield f"{at}/{n}" if at else n

    def move(self, source: str, target: str) -> None:
        """Rename a file.  A source that is gone has been moved by another writer; a target left by
        an interrupted copy of the same file is replaced."""
        self._fs.mkdirs(self.path(target).getParent())
        if not self._rename(source, target) and self.exists(source):
            self._fs.delete(self.path(target), False)
            if not self._rename(source, target) and self.exists(source):
                raise OSError(f"cannot move {source} to {target}")

    def _rename(self, source: str, target: str) -> bool:
        try:
            return bool(self._fs.rename(self.path(source), self.path(target)))
        except Py4JJavaError as e:
            if not _is_missing(e):
                raise
            return False

    def write_text(self, name: str, text: str) -> None:
        """Write a small file that appears whole or not at all.  Of several writers one wins."""
        part = self.path(f"{name}.{uuid.uuid4().hex}.part")
        self._fs.mkdirs(part.getParent())
        out = self._fs.create(part, True)
        try:
            out.write(bytearray(text.encode("utf-8")))
        finally:
            out.close()
        for _ in range(5):
            if self._rename(str(part), name):
                return
            self._fs.delete(self.path(name), False)
        self._fs.delete(part, False)
        if not self.exists(name):
            raise OSError(f"cannot write {name}")

    def read_text(self, name: str) -> str | None:
        """The text of a small file; None when there is none."""
        try:
            stream = self._fs.open(self.path(name))
        except Py4JJavaError as e:
            if not _is_missing(e):
                raise
            return None
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def delete(self, name: str) -> None:
        self._fs.delete(self.path(name), True)


def _is_missing(e: Py4JJavaError) -> bool:
    return e.java_exception.getClass().getSimpleName() in ("FileNotFoundException", "NoSuchFileException")


def holds_data(spark: SparkSession, folder: str) -> bool:
    """Whether a folder holds at least one table file (an empty or half-written one does not)."""
    return next(Files(spark, folder).data_files(folder), None) is not None
