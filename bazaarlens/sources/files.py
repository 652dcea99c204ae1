"""Folders of stored versions, through the file systems that Spark itself uses."""

from __future__ import annotations

import re

from pyspark.sql import SparkSession

from bazaarlens.operators.scratch import session_folder

_VERSION = re.compile(r"/v(\d+)(-by-key)?$")


def written_at(path: str) -> int:
    """Nanoseconds at which the version in this folder was begun; 0 if it has no time."""
    found = _VERSION.search(path)
    return int(found[1]) if found else 0


class Files:
    """Listing and deleting where tables are stored; no data passes through here."""

    def __init__(self, spark: SparkSession):
        self._context = spark.sparkContext

    def _at(self, path: str):
        where = self._context._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self._context._jsc.hadoopConfiguration()), where

    def exists(self, path: str) -> bool:
        system, where = self._at(path)
        return system.exists(where)

    def under(self, path: str) -> list[str]:
        """The folders in a folder; none if it does not exist."""
        system, where = self._at(path)
        if not system.exists(where):
            return []
        return [f"{path}/{s.getPath().getName()}" for s in system.listStatus(where) if s.isDirectory()]

    def changed_at(self, path: str) -> int:
        """Nanoseconds at which a folder last changed."""
        system, where = self._at(path)
        return system.getFileStatus(where).getModificationTime() * 1_000_000

    def delete(self, path: str) -> None:
        system, where = self._at(path)
        system.delete(where, True)


def abandoned_scratch(spark: SparkSession, files: Files, limit: int) -> list[str]:
    """Scratch folders of other sessions in which nothing was begun since ``limit``."""
    own = session_folder(spark)
    found = []
    for session in files.under(own.rsplit("/", 1)[0]):
        scratch = f"{session}/scratch"
        if session != own and files.exists(scratch) and files.changed_at(scratch) < limit:
            found.append(scratch)
    return found
