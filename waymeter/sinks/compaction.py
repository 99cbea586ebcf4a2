"""Compaction of the tables that streams write by (date, batch).

A closed date's batch folders become one folder of few files. The merged rows are staged below a hidden folder of
the table, together with the list of what they replace; then the date's folder is set aside, the staged one takes
its place, and folders that are not on the list go back. A run that dies is finished by the next one: a row is
never doubled or lost for good, but until then a reader may miss rows of that date.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from waymeter.sinks.files import BACKFILL

STAGED = "_compaction"


class _Folders:
    """Names, moves and deletions in the file system of a path; only folder names reach the driver."""

    def __init__(self, spark: SparkSession, path: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._files = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self._files.exists(self._path(path))

    def names(self, path: str, settled: float | None = None) -> list[str]:
        """Folders in a folder, at most those unchanged since `settled` (seconds)."""
        if not self.exists(path):
            return []
        found = [x for x in self._files.listStatus(self._path(path)) if x.isDirectory()]
        return sorted(x.getPath().getName() for x in found if settled is None or x.getModificationTime() <= 1000 * settled)

    def move(self, source: str, target: str) -> None:
        self._files.mkdirs(self._path(target).getParent())
        if not self._files.rename(self._path(source), self._path(target)):
            raise OSError(f"cannot move {source} to {target}")

    def delete(self, path: str) -> None:
        self._files.delete(self._path(path), True)


def _finish(spark: SparkSession, folders: _Folders, path: str, day: str) -> None:
    """From whatever step an earlier run has reached; without a complete staging nothing was changed yet."""
    staged, dated = f"{path}/{STAGED}/{day}", f"{path}/{day}"
    ready = folders.exists(f"{staged}/rows/_SUCCESS") and folders.exists(f"{staged}/merged/_SUCCESS")
    aside = f"{staged}/aside"
    if ready and not folders.exists(aside):
        folders.move(dated, aside)
    if folders.exists(aside):
        merged = [row.value for row in spark.read.text(f"{staged}/merged").collect()]
        if ready:
            folders.move(f"{staged}/rows", f"{dated}/batch_key=compacted-{time.time_ns()}")
        for name in set(folders.names(aside)) - set(merged):
            folders.move(f"{aside}/{name}", f"{dated}/{name}")
        folders.delete(aside)  # before the list of what it may hold
    folders.delete(staged)


def compact(spark: SparkSession, path: str, date_column: str, before: str, read: Callable[[SparkSession, str], DataFrame],
            settle_hours: float = 24, reduce: Callable[[DataFrame], DataFrame] | None = None) -> list[str]:
    """Merges the batch folders of every date before `before`, and returns the dates it has rewritten.

    Folders changed within `settle_hours` stay, as a stream may still replay their batch, and so do backfilled
    ones, which the next backfill replaces. `reduce` may drop rows that readers pass over anyway. A date with one
    such folder is left alone, so a second run changes nothing.
    """
    date.fromisoformat(before)
    folders = _Folders(spark, path)
    for day in folders.names(f"{path}/{STAGED}"):
        _finish(spark, folders, path, day)
    settled, done = time.time() - 3600 * settle_hours, []
    for day in folders.names(path):
        value = day.removeprefix(f"{date_column}=")
        if value == day or value >= before:  # rows without a date sort last
            continue
        merged = [x for x in folders.names(f"{path}/{day}", settled) if x.startswith("batch_key=") and x != f"batch_key={BACKFILL}"]
        if len(merged) < 2:
            continue
        keys = spark.createDataFrame([(x,) for x in merged], "value string").coalesce(1)
        # The folders' names decide, not their columns: a name may have been escaped.
        rows = spark.read.schema(read(spark, path).drop(date_column, "batch_key").schema).parquet(
            *[f"{path}/{day}/{x}" for x in merged])
        rows = reduce(rows) if reduce else rows
        keys.write.mode("overwrite").text(f"{path}/{STAGED}/{day}/merged")
        rows.hint("rebalance").write.mode("overwrite").parquet(f"{path}/{STAGED}/{day}/rows")
        _finish(spark, folders, path, day)
        done.append(value)
    return done
