"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import uuid
import warnings
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

Result = TypeVar("Result")

# AQE merges small shuffle partitions, splits skewed ones and picks join strategies at run time;
# rebalanced table writes aim at the advisory size, hence files of about that size before encoding.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    # The JVM never compiles a method over 8000 bytes; a stage that large runs faster in smaller pieces.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Readers skip by the smallest and largest moment of a row group; the default type of moments has none.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.ui.enabled": "false",
}


def build_session(
    app: str, time_zone: str, master: str | None = None, conf: dict[str, str] | None = None
) -> SparkSession:
    """Session for a job; the time zone is always stated, never inherited from the machine."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, "spark.sql.session.timeZone": time_zone, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def zoned_session(spark: SparkSession, time_zone: str) -> SparkSession:
    """Sibling session on the same cluster with its own time zone; the caller's stays as it is."""
    child = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if key.startswith("spark.sql.") and spark.conf.isModifiable(key):
            child.conf.set(key, value)
    child.conf.set("spark.sql.session.timeZone", time_zone)
    return child


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """Fresh path under the shared folder named by ``spark.checkpoint.dir``, or, where that is unset, under the
    warehouse folder, which every executor reaches as well. The path is deleted when the program ends."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    root = root or spark.conf.get("spark.sql.warehouse.dir")
    path = f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    atexit.register(delete_path, spark, path)
    return path


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of the cluster's file system, if the application still runs."""
    context = spark.sparkContext
    if context._jsc is None or context._jsc.sc().isStopped():
        return
    hadoop = context._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(context._jsc.hadoopConfiguration()).delete(hadoop, True)


def _inheriting(job: Callable[[], Result]) -> Callable[[], Result]:
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")  # tags of the session are not inherited
        return inheritable_thread_target(job)


def in_parallel(jobs: Sequence[Callable[[], Result]], threads: int = 8) -> list[Result]:
    """What ``jobs`` return, in their order; each starts its Spark jobs from a thread of the driver, so small ones share
    the cluster. The first error is raised once all have ended."""
    with ThreadPoolExecutor(max(1, min(threads, len(jobs)))) as pool:
        running = [pool.submit(_inheriting(job)) for job in jobs]
    return [job.result() for job in running]
