"""Small files and folder times, through the storage layer that Spark itself uses.

Everything here goes through Hadoop's file API, so it works wherever Spark reads
and writes. Only metadata passes: schema texts and folder times.
"""

from __future__ import annotations

import time
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

#: Folders whose entries are listed at the same time.
AT_ONCE = 16


class Storage:
    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.jvm = spark.sparkContext._jvm
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _path(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self, path: str):
        return self._path(path).getFileSystem(self.conf)

    def names(self, folder: str) -> list[str]:
        """Names in a folder, sorted; none if there is no such folder."""
        fs, path = self._fs(folder), self._path(folder)
        return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []

    def read_text(self, path: str) -> str:
        stream = self._fs(path).open(self._path(path))
        try:
            return bytes(stream.readAllBytes()).decode("utf-8")
        finally:
            stream.close()

    def write_text(self, path: str, text: str) -> None:
        """A new file, whole or not at all: written aside, then renamed."""
        fs, aside = self._fs(path), f"{path}.{uuid.uuid4().hex[:12]}.tmp"
        stream = fs.create(self._path(aside), True)
        try:
            stream.write(bytearray(text.encode("utf-8")))
        finally:
            stream.close()
        if not fs.rename(self._path(aside), self._path(path)):
            fs.delete(self._path(aside), False)
            raise FileExistsError(path)

    def modified(self, folder: str) -> int | None:
        """Time of the last change to a folder's entries (ms), None if it is gone."""
        fs, path = self._fs(folder), self._path(folder)
        return fs.getFileStatus(path).getModificationTime() if fs.exists(path) else None

    def entries(self, folder: str) -> tuple[list[str], list[str]]:
        """Sub-folders and files of a folder, not below; hidden ones left out."""
        folders, files = [], []
        for s in self._fs(folder).listStatus(self._path(folder)):
            name = s.getPath().getName()
            if not name.startswith(("_", ".")):
                (folders if s.isDirectory() else files).append(s.getPath().toString())
        return folders, files

    def changed(self, root: str, marks: dict[str, int], settled_ms: int = 5000) -> tuple[list[str], dict[str, int], int]:
        """Files of the folders below ``root`` that changed since ``marks``
        (folder -> time), the new marks, and how many folders were listed.

        A folder whose time is its mark is not listed; those known below it are
        still looked at. A folder that changed less than ``settled_ms`` ago keeps no
        mark, as more may come within the clock's grain, and neither does one whose
        store keeps no times."""
        now, marks = int(time.time() * 1000), dict(marks)
        files, new, listed = [], {}, 0
        below: dict[str, list[str]] = {}
        for folder in marks:
            below.setdefault(folder.rpartition("/")[0], []).append(folder)

        def look(folder):
            at = self.modified(folder)
            if at is None:
                return folder, None, [], []
            if marks.get(folder) == at and at:
                return folder, at, below.get(folder, []), None
            return (folder, at, *self.entries(folder))

        todo = [self._fs(root).makeQualified(self._path(root)).toString()]
        with ThreadPoolExecutor(AT_ONCE) as pool:
            while todo:
                seen = list(pool.map(look, todo))
                todo = []
                for folder, at, folders, found in seen:
                    todo += folders
                    if found is not None:
                        listed += at is not None
                        files += found
                    if at and now - at > settled_ms:
                        new[folder] = at
        return files, new, listed
