"""Exact deduplication of whole texts by a stateful stream.

The stream's keyed state holds, for each digest of a text, the row that stays (smallest identifier), where that row's
content lies, and how many rows had the digest. It is kept on the executors' disks (RocksDB), logged to the checkpoint
folder and never expires: a run goes on where the last one ended and reads only files that came since.

Equal digests are only a hit. The whole bytes of all texts of a digest are compared before a row counts as a copy.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from farelake.streaming.state import disk_state

from .common import GAP, scratch, shuffled, steps, stored

#: Bytes of files that one batch of the stream takes.
BATCH_BYTES = 256 << 30
_ENTRY = "digest binary, keep struct<unnamed:boolean,doc_id:{0},file:bigint,row:bigint>, group_size bigint"


def normalised(text: Column) -> Column:
    """A text with each run of white space as one space; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), GAP, " ")


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _documents(spark: SparkSession, path: str) -> StructType:
    """Type of the two columns that are read, whatever others there are."""
    given = spark.read.parquet(path).schema
    return StructType([given["doc_id"], given["text"]])


def _pattern(path: str) -> str:
    """``path`` as a pattern that only it matches: Spark streams from one file only if it is given as a pattern."""
    path = path.rstrip("/")
    return f"{path[:-1]}[{path[-1]}]"


def _located(rows: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    """``doc_id``, ``file`` (hash of its path) and ``row`` within it, ``whole`` (the normalised text), ``digest``."""
    whole = normalised(F.col("text"))
    return rows.select(
        "doc_id",
        F.xxhash64(F.col("_metadata.file_path")).alias("file"),
        F.col("_metadata.row_index").alias("row"),
        whole.alias("whole"),
        digest(whole).alias("digest"),
    )


def _first() -> Column:
    """Of equal texts, the row that stays: smallest id, rows without one last, then the place."""
    return F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "file", "row"))


def follow(
    spark: SparkSession,
    path: str,
    folder: str,
    digest: Callable[[Column], Column] = sha256,
    batch: dict[str, str] | None = None,
) -> None:
    """Brings the state in ``folder`` up to the files that lie at ``path`` now, then ends.

    Each batch writes the entries that it changed to ``folder/changes``, by its number, so a batch that runs again
    replaces its own. ``batch`` holds the file source's limits of a batch (``maxBytesPerTrigger``,
    ``maxFilesPerTrigger``)."""
    source = spark.readStream.schema(_documents(spark, path))
    source = source.options(**(batch or {"maxBytesPerTrigger": str(BATCH_BYTES)}))
    rows = _located(source.parquet(_pattern(path)), digest).drop("whole")
    entries = rows.groupBy("digest").agg(_first().alias("keep"), F.count(F.lit(1)).alias("group_size"))

    def changed(entries: DataFrame, number: int) -> None:
        entries.write.mode("overwrite").parquet(f"{folder}/changes/batch={number}")

    with disk_state(spark):
        query = (
            entries.writeStream.outputMode("update")
            .foreachBatch(changed)
            .option("checkpointLocation", f"{folder}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )
    try:
        query.awaitTermination()
    finally:
        query.stop()


def entries(spark: SparkSession, path: str, folder: str) -> DataFrame:
    """The state's entry of each digest: a digest's count only grows, so its latest change has the largest."""
    kind = _documents(spark, path)["doc_id"].dataType.simpleString()
    schema = _ENTRY.format(kind)
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(f"{folder}/changes/batch=-1")
    changes = spark.read.schema(schema).parquet(f"{folder}/changes")
    latest = F.max_by(F.struct("keep", "group_size"), "group_size").alias("e")
    return changes.groupBy("digest").agg(latest).select("digest", "e.keep", "e.group_size")


def exact_duplicates(
    spark: SparkSession,
    path: str,
    folder: str | None = None,
    digest: Callable[[Column], Column] = sha256,
    batch: dict[str, str] | None = None,
) -> DataFrame:
    """A row for each row of the Parquet files at ``path`` (``doc_id``, ``text``): ``doc_id``, ``file`` and ``row``
    (where it lies), ``digest``, ``keep_id``, ``group_size``, ``kept``.

    Texts are equal when identical after each run of white space (space, tab to carriage return) became one space; null
    counts as empty. Of equal texts the row with the smallest id stays; rows with null ids come last, and of rows with
    equal ids the one that lies first, so exactly one row of a group is ``kept``. ``keep_id`` is null where a group has
    null ids only. Other columns are not read, and an empty table gives no rows. No file may be added meanwhile, and
    files are not changed or removed once read.

    ``folder`` holds the state. With a folder of an earlier call only new files go through the stream; without one the
    state is made anew. Texts that share a digest without being equal are grouped by their whole bytes instead.
    """
    folder = folder or f"{scratch(spark)}/exact-{uuid.uuid4().hex}"
    follow(spark, path, folder, digest, batch)
    with steps(spark) as kept:
        index = stored(entries(spark, path, folder), "entries")
        here = _located(spark.read.schema(_documents(spark, path)).parquet(path), digest)
        places = stored(here.drop("whole"), "places")
        # One text stands for all equal ones of a task before anything is shuffled, so a large group costs little.
        ends = here.groupBy("digest").agg(F.min("whole").alias("lo"), F.max("whole").alias("hi"))
        unlike = stored(ends.where("lo <> hi").select("digest"), "unlike")
        found = places.join(shuffled(index), "digest")
        if not unlike.isEmpty():
            odd = stored(here.join(shuffled(unlike), "digest"), "odd")
            by_bytes = odd.groupBy("digest", "whole").agg(_first().alias("keep"), F.count(F.lit(1)).alias("group_size"))
            apart = odd.join(shuffled(stored(by_bytes, "by_bytes")), ["digest", "whole"]).drop("whole")
            found = found.join(shuffled(unlike), "digest", "left_anti").unionByName(apart)
        out = stored(
            found.select(
                "doc_id",
                "file",
                "row",
                "digest",
                F.col("keep.doc_id").alias("keep_id"),
                "group_size",
                ((F.col("keep.file") == F.col("file")) & (F.col("keep.row") == F.col("row"))).alias("kept"),
            ),
            "exact",
        )
        kept.append(out)
    return out


def drop_copies(spark: SparkSession, path: str, folder: str | None = None) -> DataFrame:
    """The rows at ``path`` that stay, with all of their columns; see ``exact_duplicates``."""
    gone = exact_duplicates(spark, path, folder).where("not kept").select("file", "row")
    rows = spark.read.parquet(path)
    place = rows.metadataColumn("_metadata")
    on = (F.xxhash64(place["file_path"]) == gone["file"]) & (place["row_index"] == gone["row"])
    return rows.join(shuffled(gone), on, "left_anti")


EXACT_SQL = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = min(doc_id) OVER g AS kept,
  text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)
"""
