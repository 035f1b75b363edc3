"""Tables as folders that never change, and small numbered files that say which of them are the table.

Whatever is written goes to a folder of its own, which nobody reads yet. The last step is one small file with the next
number: it names all folders that make up the table from now on. A job that is lost before that step leaves the table as it
was; one that is lost after it has changed the table. No folder is ever renamed or overwritten in place.
"""

from __future__ import annotations

import json
import threading
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

# Commit files that stay behind the newest one, and how long folders stay that no commit names any more: a job that read an
# earlier state may still be at work on them.
KEPT = 12
KEEP_SECONDS = 24 * 3600
TRIES = 20
_one_at_a_time = threading.RLock()


class LostRace(RuntimeError):
    """Another writer took the number of a commit again and again."""


def files_of(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path for it."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that this package has written."""
    files, jvm_path = files_of(spark, path)
    files.delete(jvm_path, True)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    files, jvm_path = files_of(spark, path)
    if not files.exists(jvm_path):
        return []
    return sorted(s.getPath().getName() for s in files.listStatus(jvm_path) if s.isDirectory())


@dataclass(frozen=True)
class CommitLog:
    """States of a table, as JSON objects under `folder`/_commits. Only the newest one counts."""

    spark: SparkSession
    folder: str

    def _path(self, number: int) -> str:
        return f"{self.folder}/_commits/{number:012d}.json"

    def numbers(self) -> list[int]:
        files, folder = files_of(self.spark, f"{self.folder}/_commits")
        if not files.exists(folder):
            return []
        names = (s.getPath().getName() for s in files.listStatus(folder))
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0].isdigit())

    def read(self, number: int) -> dict:
        files, path = files_of(self.spark, self._path(number))
        stream = files.open(path)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def latest(self) -> tuple[int, dict]:
        """Number and state of the newest commit; 0 and nothing before the first."""
        numbers = self.numbers()
        return (numbers[-1], self.read(numbers[-1])) if numbers else (0, {})

    def commit(self, change: Callable[[dict], dict | None]) -> dict:
        """Replace the state by `change` of it; None leaves it. Starts over if another writer was faster."""
        for _ in range(TRIES):
            with _one_at_a_time:
                number, state = self.latest()
                after = change(state)
                if after is None:
                    return state
                if self._put(number + 1, after):
                    self._forget(number + 1 - KEPT)
                    return after
        raise LostRace(f"no commit under {self.folder} in {TRIES} tries")

    def _put(self, number: int, state: dict) -> bool:
        """Write a commit under its number unless that number is there. The file appears whole or not at all."""
        files, draft = files_of(self.spark, f"{self.folder}/_commits/.{uuid.uuid4().hex}")
        out = files.create(draft, True)
        out.write(bytearray(json.dumps(state).encode()))
        out.close()
        jvm, path = self.spark._jvm, files_of(self.spark, self._path(number))[1]
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(path.toUri(), self.spark._jsc.hadoopConfiguration())
        never_over = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(files.makeQualified(draft), files.makeQualified(path), never_over)
        except Py4JJavaError as failed:
            files.delete(draft, False)
            if "AlreadyExists" in failed.java_exception.getClass().getName() or files.exists(path):
                return False
            raise
        return True

    def _forget(self, until: int) -> None:
        for number in self.numbers():
            if number <= until:
                files, path = files_of(self.spark, self._path(number))
                files.delete(path, False)


def retired(state: dict, gone: list[str]) -> list[list]:
    """The state's list of folders that no commit names any more, with the time since when, and `gone` added."""
    return [*state.get("retired", []), *([time.time(), f] for f in gone)]


def swept(spark: SparkSession, state: dict) -> dict:
    """Delete folders that have been retired for long enough for every reader to be done, and take them off the list."""
    now = time.time()
    for since, folder in state.get("retired", []):
        if now - since > KEEP_SECONDS:
            remove_folder(spark, folder)
    return state | {"retired": [x for x in state.get("retired", []) if now - x[0] <= KEEP_SECONDS]}
