"""Session settings and the shared folder that written tables and checkpoints go to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

# AQE joins small reduce tasks by the bytes that a shuffle really wrote, splits skewed join
# partitions, and turns a sort-merge join into a broadcast join once the measured side is below the
# threshold. It cannot raise the number of reduce tasks: see `sized_for`.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.sources.partitionOverwriteMode": "static",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

_local_folders: dict[str, str] = {}


def build_session(name: str, master: str | None = None, **extra: str) -> SparkSession:
    """Session with the engine's settings; `extra` keys use `__` for `.`."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def sized_for(shuffled_bytes: int, per_task: int = 256 << 20) -> dict[str, str]:
    """Settings for the largest shuffle expected: AQE starts from so many reduce tasks and joins
    the small ones. The KPI jobs shuffle at most the columns they read, once or twice."""
    tasks = max(200, -(-shuffled_bytes // per_task))
    return {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(tasks)}


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, named by the cluster in `spark.checkpoint.dir`.

    Only a local master may go without the setting; it then gets one temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="yieldline-")
    return _local_folders[context.applicationId]


def new_folder(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/yieldline/{label}-{uuid.uuid4().hex}"


def at_once(spark: SparkSession, jobs: list[Callable], threads: int = 4) -> list:
    """Run independent jobs from several threads, so that one's small stages fill idle cores."""
    carry = inheritable_thread_target(spark)
    with ThreadPoolExecutor(threads) as pool:
        return [done.result() for done in [pool.submit(carry(job)) for job in jobs]]
