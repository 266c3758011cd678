"""Insert-or-replace by key, for stores with and without such an operation of their own.

A table without ``day`` is a row of whole versions. With it each day is a folder that has versions of its own, so a batch
rewrites only the days that it touches. A version counts once its marker is there.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from hashlib import sha256

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelake.functions.identity import with_row_ids
from farelake.session import delete_path

KEEP_VERSIONS = 3
NO_DAY = "__HIVE_DEFAULT_PARTITION__"


def _versions(spark: SparkSession, target: str) -> tuple[object, list[int]]:
    """File system of ``target`` and its completely written versions, oldest first."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return fs, []
    found = []
    for status in fs.listStatus(path):
        name = status.getPath().getName()
        marker = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
        if name.startswith("version-") and fs.exists(marker):
            found.append(int(name.removeprefix("version-")))
    return fs, sorted(found)


def _version_path(target: str, version: int) -> str:
    return f"{target.rstrip('/')}/version-{version:012d}"


def read_upserted(spark: SparkSession, target: str) -> DataFrame | None:
    """Rows of the newest complete version, or of each day's, or None before the first."""
    newest = {day: complete[-1] for day, (_, complete) in _day_versions(spark, target).items() if complete}
    if newest:
        return _read_days(spark, target, newest)
    _, versions = _versions(spark, target)
    return spark.read.parquet(_version_path(target, versions[-1])) if versions else None


def _day_versions(spark: SparkSession, target: str, days: Sequence[str] | None = None) -> dict[str, tuple[int, list[int]]]:
    """By day the last version, complete or not, and the complete ones, oldest first; of ``days`` or of all days."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    root = hadoop(target)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found: dict[str, tuple[int, list[int]]] = {}
    for day in ["*"] if days is None else days:
        for status in fs.globStatus(hadoop(f"{target.rstrip('/')}/day={day}/version=*")) or []:
            path = status.getPath()
            name, version = path.getParent().getName().removeprefix("day="), int(path.getName().removeprefix("version="))
            last, complete = found.get(name, (-1, []))
            if fs.exists(hadoop(path, "_SUCCESS")):
                complete = sorted([*complete, version])
            found[name] = (max(last, version), complete)
    return found


def _day_path(target: str, day: str, version: int) -> str:
    return f"{target.rstrip('/')}/day={day}/version={version}"


def _read_days(spark: SparkSession, target: str, versions: dict[str, int]) -> DataFrame:
    paths = [_day_path(target, day, version) for day, version in versions.items()]
    return spark.read.option("basePath", target).parquet(*paths).drop("day", "version")


def _merged(both: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One row for each key; of rows of one batch that share a key the greatest stays, however they are partitioned."""
    kept = F.max(F.struct("is_new", *[c for c in columns if c not in keys])).alias("kept")
    others = [F.col(f"kept.{c}").alias(c) if c not in keys else F.col(c) for c in columns]
    return both.groupBy(*keys).agg(kept).select(*others)


def _folder_of(batch: DataFrame, day: str) -> Column:
    """A row's day, whatever the session's time zone: of a moment that in UTC."""
    if isinstance(batch.schema[day].dataType, T.TimestampType):
        date = F.date_from_unix_date(F.floor(F.unix_seconds(day) / 86400).cast("int"))
    else:
        date = F.to_date(day)
    return F.coalesce(F.date_format(date, "yyyy-MM-dd"), F.lit(NO_DAY))


def _upsert_days(batch: DataFrame, target: str, keys: Sequence[str], day: str) -> None:
    spark = batch.sparkSession
    # A stateful batch may be computed only once, so it is stored before its days are asked for.
    staged = f"{target.rstrip('/')}/_staged-{uuid.uuid4().hex}"
    try:
        batch.withColumn("day", _folder_of(batch, day)).write.parquet(staged)
        rows = spark.read.parquet(staged)
        days = [r.day for r in rows.select("day").distinct().collect()]
        if not days:
            return
        there = _day_versions(spark, target, days)
        both = rows.drop("day").withColumn("is_new", F.lit(1))
        newest = {name: complete[-1] for name, (_, complete) in there.items() if complete}
        if newest:
            both = _read_days(spark, target, newest).withColumn("is_new", F.lit(0)).unionByName(both)
        merged = _merged(both, keys, batch.columns)
        # One version for all days of the batch, past those that an earlier attempt may have begun.
        version = 1 + max((last for last, _ in there.values()), default=-1)
        out = merged.withColumn("day", _folder_of(merged, day)).withColumn("version", F.lit(version))
        out = out.hint("rebalance", F.col("day"))
        out.write.mode("append").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").partitionBy(
            "day", "version"
        ).parquet(target)
    finally:
        delete_path(spark, staged)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = hadoop(target).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for name in days:
        fs.create(hadoop(_day_path(target, name, version), "_SUCCESS"), True).close()
        for old in there.get(name, (-1, []))[1][: -(KEEP_VERSIONS - 1)]:
            fs.delete(hadoop(_day_path(target, name, old)), True)


def upsert(batch: DataFrame, target: str, keys: Sequence[str], whole: bool = False, day: str | None = None) -> None:
    """Replace the rows of ``target`` that share a key with ``batch``, add the others.

    Each call writes the next version; readers see it once it is complete. Meant for small
    keyed results such as window counts, whose size follows the calendar. A batch that is replayed
    after a failure replaces its own rows, so the table stays the same. With ``day``, a date or timestamp among the
    keys, only the days that ``batch`` has rows of are read and written; readers see each day's newest version. With
    ``whole`` the batch is all of the table, as in complete output mode: it becomes the next version, and the old one
    isn't read.
    """
    if day is not None:
        if whole or day not in keys:
            raise ValueError("a table by day is upserted in part, and the day is one of its keys")
        _upsert_days(batch, target, keys, day)
        return
    spark = batch.sparkSession
    fs, versions = _versions(spark, target)
    # The batch may come from a stateful query, so the plan must contain it only once.
    both = batch.withColumn("is_new", F.lit(1))
    if versions and not whole:
        current = spark.read.parquet(_version_path(target, versions[-1]))
        both = current.withColumn("is_new", F.lit(0)).unionByName(both)
    rows = _merged(both, keys, batch.columns)
    following = versions[-1] + 1 if versions else 0
    # One or a few files: AQE merges the small partitions.
    rows.hint("rebalance").write.mode("overwrite").parquet(_version_path(target, following))
    for old in versions[: -(KEEP_VERSIONS - 1)]:
        fs.delete(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_version_path(target, old)), True)


def upsert_batches(
    target: str, keys: Sequence[str], whole: bool = False, day: str | None = None
) -> Callable[[DataFrame, int], None]:
    """Per-batch function for ``foreachBatch`` that upserts into ``target``; ``whole`` for complete output mode."""

    def write(batch: DataFrame, batch_id: int) -> None:
        upsert(batch, target, keys, whole, day)

    return write


def document_options(uri: str, database: str, collection: str, keys: Sequence[str] = ()) -> dict[str, str]:
    """Options of the MongoDB connector; with keys it replaces the document that has the same ones."""
    options = {"connection.uri": uri, "database": database, "collection": collection}
    if keys:
        options |= {"operationType": "update", "upsertDocument": "true", "idFieldList": ",".join(keys)}
    return options


def upsert_documents(
    uri: str, database: str, collection: str, keys: Sequence[str], source: str = "mongodb"
) -> Callable[[DataFrame, int], None]:
    """Per-batch function that upserts into a document store, whose connector the cluster provides."""

    def write(batch: DataFrame, batch_id: int) -> None:
        options = document_options(uri, database, collection, keys)
        batch.write.format(source).mode("append").options(**options).save()

    return write


def append_documents(
    uri: str,
    database: str,
    collection: str,
    checkpoint: str,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    store: Callable[[DataFrame], None] | None = None,
) -> Callable[[DataFrame, int], None]:
    """Per-batch function that adds each row of each batch once to a document store.

    A document's id is made of the stream (its checkpoint folder), the batch, the row's content and its number among
    equal rows. A batch that runs again replaces its own documents; equal rows of one or several batches all stay.
    ``store`` replaces the connector, which the cluster provides.
    """
    stream = sha256(checkpoint.rstrip("/").encode()).hexdigest()[:8]

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = with_row_ids(prepare(batch) if prepare else batch, f"{stream}-{batch_id}")
        if store:
            store(rows)
            return
        rows.write.format("mongodb").mode("append").options(**document_options(uri, database, collection, ["_id"])).save()

    return write
