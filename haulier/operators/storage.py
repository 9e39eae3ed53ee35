"""Hadoop file system calls below one folder: listing, renaming, deleting, small marker files.

Only metadata passes through the driver, and only for the folders a commit touches. Row data is
always read and written by Spark jobs.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from ..errors import CommitError

_RENAME_THREADS = 16


class Storage:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self._jvm = spark.sparkContext._jvm
        self._hadoop = self._jvm.org.apache.hadoop.fs
        self._root = self._hadoop.Path(root.rstrip("/"))
        self._fs = self._root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._base = self._fs.makeQualified(self._root).toString()

    def _path(self, relative: str = ""):
        return self._hadoop.Path(self._root, relative) if relative else self._root

    def url(self, relative: str = "") -> str:
        return f"{self._base}/{relative}" if relative else self._base

    def exists(self, relative: str = "") -> bool:
        return self._fs.exists(self._path(relative))

    def glob(self, pattern: str) -> list[str]:
        """Relative paths that match; the matching itself runs in the JVM."""
        found = self._fs.globStatus(self._path(pattern))
        if not found:
            return []
        cut = len(self._base) + 1
        return sorted(path.toString()[cut:] for path in self._hadoop.FileUtil.stat2Paths(found))

    def any(self, pattern: str) -> bool:
        return len(self._fs.globStatus(self._path(pattern)) or []) > 0

    def first(self, pattern: str) -> str | None:
        found = self._fs.globStatus(self._path(pattern)) or []
        return found[0].getPath().toString()[len(self._base) + 1 :] if len(found) else None

    def summary(self, relative: str = "") -> tuple[int, int]:
        """(files, bytes) below a folder, counted by the file system itself."""
        found = self._fs.getContentSummary(self._path(relative))
        return found.getFileCount(), found.getLength()

    def make_folder(self, relative: str = "") -> None:
        self._fs.mkdirs(self._path(relative))

    def delete(self, relative: str = "") -> None:
        path = self._path(relative)
        if self._fs.exists(path) and not self._fs.delete(path, True):
            raise CommitError(f"could not delete {path.toString()}")

    def delete_on_exit(self) -> None:
        """Mark the folder, which must exist, for removal when the driver's JVM ends."""
        self._fs.deleteOnExit(self._root)

    def rename(self, source: str, destination: str) -> None:
        target = self._path(destination)
        self._fs.mkdirs(target.getParent())
        # Hadoop would move the source *into* an existing folder instead of failing.
        if self._fs.exists(target) or not self._fs.rename(self._path(source), target):
            raise CommitError(f"could not rename {source} to {destination} below {self._base}")

    def rename_all(self, moves: list[tuple[str, str]]) -> None:
        """Independent renames, several at a time."""
        with ThreadPoolExecutor(_RENAME_THREADS) as pool:
            list(pool.map(lambda move: self.rename(*move), moves))

    def move_files(self, moves: list[tuple[str, str]]) -> None:
        """Move single files to names that are new; each folder is made once."""
        for folder in sorted({destination.rpartition("/")[0] for _, destination in moves}):
            self.make_folder(folder)
        with ThreadPoolExecutor(_RENAME_THREADS) as pool:
            list(pool.map(lambda move: self.move_file(*move), moves))

    def move_file(self, source: str, destination: str) -> None:
        if not self._fs.rename(self._path(source), self._path(destination)):
            raise CommitError(f"could not move {source} to {destination} below {self._base}")

    def delete_all(self, paths: list[str]) -> None:
        with ThreadPoolExecutor(_RENAME_THREADS) as pool:
            list(pool.map(self.delete, paths))

    def write_text(self, relative: str, text: str) -> None:
        stream = self._fs.create(self._path(relative), True)
        try:
            stream.write(bytearray(text, "utf-8"))
        finally:
            stream.close()

    def create_text(self, relative: str, text: str) -> bool:
        """Write a new file in one go; False if there is one by that name, which stays as it is."""
        try:
            stream = self._fs.create(self._path(relative), False)
        except Py4JJavaError as error:
            if "FileAlreadyExists" in str(error.java_exception) or self.exists(relative):
                return False
            raise
        try:
            stream.write(bytearray(text, "utf-8"))
        finally:
            stream.close()
        return True

    def read_text_or_none(self, relative: str) -> str | None:
        """Like :meth:`read_text`, also for a file that is deleted meanwhile."""
        try:
            return self.read_text(relative)
        except Py4JJavaError:
            if self.exists(relative):
                raise
            return None

    def read_text(self, relative: str) -> str | None:
        if not self.exists(relative):
            return None
        stream = self._fs.open(self._path(relative))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
