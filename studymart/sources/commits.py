"""Numbered commits in a folder: the one step at which what was written becomes visible."""

import json
import re
import uuid

from pyspark.sql import SparkSession

from studymart.sources.files import _hadoop_path

_NAME = re.compile(r"(\d{20})\.json")


class CommitConflict(RuntimeError):
    """Another writer took the number."""


class CommitLog:
    """Commits ``1, 2, ...`` of a folder, each a small JSON object.

    A commit is written beside the log and renamed into it, so it is there whole or not at all, and
    its number can be taken once. That holds where a rename doesn't replace, as on HDFS; on stores
    where it does, let one writer at a time commit to a log.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _path(self, version: int) -> str:
        return f"{self.folder}/{version:020d}.json"

    def versions(self) -> list[int]:
        target, files = _hadoop_path(self.spark, self.folder)
        if not files.exists(target):
            return []
        names = (s.getPath().getName() for s in files.listStatus(target))
        return sorted(int(m[1]) for n in names if (m := _NAME.fullmatch(n)))

    def read(self, version: int) -> dict:
        target, files = _hadoop_path(self.spark, self._path(version))
        stream = files.open(target)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def latest(self) -> tuple[int, dict]:
        """The last commit and its number; 0 and an empty object before the first."""
        versions = self.versions()
        return (versions[-1], self.read(versions[-1])) if versions else (0, {})

    def commit(self, version: int, content: dict) -> None:
        """Takes the number, or raises `CommitConflict`."""
        target, files = _hadoop_path(self.spark, self._path(version))
        draft, _ = _hadoop_path(self.spark, f"{self.folder}/_{uuid.uuid4().hex}")
        out = files.create(draft, True)
        out.write(bytearray(json.dumps(content).encode()))
        out.close()
        if files.exists(target) or not files.rename(draft, target):
            files.delete(draft, False)
            raise CommitConflict(self._path(version))


def remove(spark: SparkSession, path: str) -> None:
    target, files = _hadoop_path(spark, path)
    files.delete(target, True)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none if it isn't there."""
    target, files = _hadoop_path(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(target)) if files.exists(target) else []


def move(spark: SparkSession, path: str, to: str) -> None:
    """Rename a file or folder, making the folder it goes to; done already is done."""
    source, files = _hadoop_path(spark, path)
    target, _ = _hadoop_path(spark, to)
    files.mkdirs(target.getParent())
    if not files.rename(source, target) and not (files.exists(target) and not files.exists(source)):
        raise OSError(f"can't move {path} to {to}")
