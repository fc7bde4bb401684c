"""Which files a table has loaded.

Below the folder of a table lie ``_ledger`` and ``_staged``. A load writes its rows to a staged
folder and the files it read (path, length, time of change) to the ledger; neither counts until one
commit names the load. Then the staged rows are moved into the table. A load that dies before
its commit leaves nothing that is read; one that dies after it is completed by whoever opens the
ledger next. So files and rows are committed together.
"""

import logging
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from studymart.sources.commits import CommitConflict, CommitLog, folder_names, move, remove
from studymart.sources.files import MissingInput

FILE_SCHEMA = "path string, length long, changed_at timestamp"
LOAD = "load_id"  # partition column of a table that keeps its loads apart

log = logging.getLogger(__name__)


class ChangedInput(ValueError):
    """Files that were loaded have changed since; carries some of their paths."""

    def __init__(self, paths: Sequence[str]):
        self.paths = list(paths)
        super().__init__("changed since they were loaded: " + ", ".join(self.paths))


class ConcurrentLoad(RuntimeError):
    """Another load committed the same files meanwhile; nothing of this one is visible."""


def list_files(
    spark: SparkSession, paths: str | Sequence[str], glob: str | None = None, pattern: str | None = None
) -> DataFrame:
    """(path, length, changed_at) of the files below paths, from their listing alone.

    ``glob`` chooses by name, ``pattern`` by a regular expression on the path.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    try:
        found = reader.load(paths)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        raise MissingInput(", ".join(paths)) from error
    found = found.select("path", "length", F.col("modificationTime").alias("changed_at"))
    return found.where(F.col("path").rlike(pattern)) if pattern else found


class Ledger:
    """The loads of the table at ``root``; ``apart`` tables keep each in a folder ``load_id=...``."""

    def __init__(self, spark: SparkSession, root: str, apart: bool = False):
        self.spark, self.root, self.apart = spark, root.rstrip("/"), apart
        self.log = CommitLog(spark, f"{self.root}/_ledger")
        self._publish_staged()

    def commits(self) -> DataFrame:
        """(version, load_id, source) of every committed load."""
        schema = f"version long, {LOAD} string, source string"
        if not self.log.versions():
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).json(f"{self.log.folder}/[0-9]*.json")

    def files(self) -> DataFrame:
        """The files of all committed loads (``FILE_SCHEMA``, load_id)."""
        if not self.log.versions():
            return self.spark.createDataFrame([], f"{FILE_SCHEMA}, {LOAD} string")
        listed = self.spark.read.schema(f"{FILE_SCHEMA}, {LOAD} string").parquet(f"{self.log.folder}/files")
        return listed.join(self.commits(), LOAD, "left_semi")

    def unloaded(self, found: DataFrame) -> DataFrame:
        """Of listed files those that no load holds as they are now; ``changed``: an older state is held."""
        known = self.files().groupBy("path").agg(
            F.collect_set(F.struct(F.col("length").alias("l"), F.col("changed_at").alias("c"))).alias("states")
        )
        now = F.struct(F.col("length").alias("l"), F.col("changed_at").alias("c"))
        joined = found.join(known, "path", "left").where(F.col("states").isNull() | ~F.array_contains("states", now))
        return joined.select("path", "length", "changed_at", F.col("states").isNotNull().alias("changed"))

    def staged(self, load: str) -> str:
        """The folder a load writes its rows to."""
        return f"{self.root}/_staged/{load}"

    def commit(self, load: str, files: DataFrame, source: str = "") -> None:
        """Make the staged rows of a load visible, and its files loaded, in one step."""
        listed = f"{self.log.folder}/files/{LOAD}={load}"
        files.select("path", "length", "changed_at").write.mode("overwrite").parquet(listed)
        seen = self.log.versions()
        version = (seen[-1] if seen else 0) + 1
        while True:
            try:
                self.log.commit(version, {"version": version, LOAD: load, "source": source})
                break
            except CommitConflict:
                own = self.spark.read.parquet(listed)
                both = self.files().where(F.col(LOAD) != load).join(own, own.columns, "left_semi")
                if not both.isEmpty():
                    remove(self.spark, listed)
                    remove(self.spark, self.staged(load))
                    raise ConcurrentLoad(self.root) from None
                version += 1
        self._publish(load)

    def _publish(self, load: str) -> None:
        staged = self.staged(load)
        if self.apart:
            remove(self.spark, f"{staged}/_SUCCESS")
            move(self.spark, staged, f"{self.root}/{LOAD}={load}")
            return
        for name in folder_names(self.spark, staged):
            if not name.startswith(("_", ".")):
                move(self.spark, f"{staged}/{name}", f"{self.root}/{name}")
        remove(self.spark, staged)

    def _publish_staged(self) -> None:
        """Complete loads that died between their commit and the move of their rows."""
        staged = folder_names(self.spark, f"{self.root}/_staged")
        if staged:
            done = self.commits().where(F.col(LOAD).isin(staged)).select(LOAD).collect()
            for row in done:
                self._publish(row[LOAD])


def new_load() -> str:
    return uuid.uuid4().hex


def batches(files: DataFrame, size: int, changed: str) -> list[list]:
    """The rows of `Ledger.unloaded`, oldest first, in lists of at most ``size``.

    ``changed`` tells what becomes of files an older state of which was loaded: ``"raise"``, ``"skip"``
    or ``"append"``. Only paths, lengths and times reach the driver, as they do in any listing.
    """
    if changed not in ("raise", "skip", "append"):
        raise ValueError(changed)
    if changed != "append":
        told = [r.path for r in files.where("changed").orderBy("path").limit(20).collect()]
        if told and changed == "raise":
            raise ChangedInput(told)
        if told:
            log.warning("changed since they were loaded, left out: %s", ", ".join(told))
            files = files.where("NOT changed")
    rows = files.orderBy("changed_at", "path").select("path", "length", "changed_at").collect()
    return [rows[i : i + size] for i in range(0, len(rows), size)]
