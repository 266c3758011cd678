"""Stored tables: written whole or by partition, so that a second run gives the same table."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from farelake.schemas import SORT_KEYS, TABLES, assert_contract
from farelake.session import delete_path


def write_parquet(
    df: DataFrame,
    path: str,
    order_by: Sequence[str] = (),
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
    replace: str = "table",
    clustered: bool = False,
) -> int:
    """Write files sorted by ``order_by``; returns the rows written, counted while they are.

    With ``partition_by`` rows are brought together per partition folder first. The rebalance hint lets
    AQE split a folder that holds much of the data over many tasks and merge small ones. An overwrite
    replaces the whole table, or with ``replace="partitions"`` only the folders that get rows. A whole
    table is written beside the old one and takes its place when it is complete, so a write that fails
    leaves the old table as it was. ``clustered`` deals rows to files by sampled ranges of ``order_by``, at the price of
    a shuffle: a file then spans a small part of the keys, and readers skip the others by their statistics.
    """
    spark = df.sparkSession
    recover(spark, path)
    if clustered and not partition_by:
        # Equal rows may go to several ranges, so that a key which a third of them share is split.
        spread = F.xxhash64(F.monotonically_increasing_id())
        df = df.repartitionByRange(*[F.col(c) for c in order_by], spread)
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    if order_by:
        df = df.sortWithinPartitions(*partition_by, *order_by)
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode(mode)
    if partition_by:
        overwrite = "dynamic" if replace == "partitions" else "static"
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", overwrite)
    if mode != "overwrite" or (partition_by and replace == "partitions"):
        writer.parquet(path)
        return seen.get["rows"]
    aside = f"{path.rstrip('/')}.new-{uuid.uuid4().hex}"
    try:
        writer.parquet(aside)
        _take_place(spark, aside, path)
    finally:
        delete_path(spark, aside)
    return seen.get["rows"]


def standing(spark: SparkSession, path: str) -> str:
    """Where the table of ``path`` is: there, or aside for the moment between the two renames of a replacement, which
    may have ended there."""
    context = spark.sparkContext
    hadoop = context._jvm.org.apache.hadoop.fs.Path
    fs = hadoop(path).getFileSystem(context._jsc.hadoopConfiguration())
    if not fs.exists(hadoop(path)):
        for status in fs.globStatus(hadoop(f"{path.rstrip('/')}.old-*")) or []:
            return status.getPath().toString()
    return path


def recover(spark: SparkSession, path: str) -> None:
    """Undo a replacement that ended between its two renames: the old table comes back to its place."""
    aside = standing(spark, path)
    if aside != path:
        context = spark.sparkContext
        source, target = (context._jvm.org.apache.hadoop.fs.Path(p) for p in (aside, path.rstrip("/")))
        if not target.getFileSystem(context._jsc.hadoopConfiguration()).rename(source, target):
            raise OSError(f"cannot bring {path} back from {aside}")


def _take_place(spark: SparkSession, new: str, path: str) -> None:
    """Rename the folder ``new`` to ``path``; what was there goes afterwards."""
    context = spark.sparkContext
    source, target = (context._jvm.org.apache.hadoop.fs.Path(p) for p in (new, path))
    old = context._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}.old-{uuid.uuid4().hex}")
    fs = target.getFileSystem(context._jsc.hadoopConfiguration())
    had = fs.exists(target)
    if had and not fs.rename(target, old):
        raise OSError(f"cannot move {path} aside")
    if not fs.rename(source, target):
        if had:
            fs.rename(old, target)
        raise OSError(f"cannot move the new table to {path}")
    if had:
        fs.delete(old, True)
    spark.catalog.refreshByPath(path)


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def write_star_or_mart(
    df: DataFrame,
    root: str,
    name: str,
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
    clustered: bool = False,
) -> int:
    """Check a table of the warehouse against its contract and write it in its sort order; returns its rows."""
    assert_contract(df.drop(*partition_by), TABLES[name], name)
    return write_parquet(df, table_path(root, name), SORT_KEYS[name], partition_by, mode, clustered=clustered)


def read_star_or_mart(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A stored table with the columns of its contract, in their order."""
    return spark.read.parquet(standing(spark, table_path(root, name))).select(*TABLES[name].names)


def summary_of(spark: SparkSession, rows: dict[str, int]) -> DataFrame:
    """Rows per table, as they were counted while it was written."""
    return spark.createDataFrame(list(rows.items()), "table_name string, row_count long")


def run_summary(spark: SparkSession, root: str, names: Sequence[str]) -> DataFrame:
    """Rows per stored table, counted from the files: nothing is computed again."""
    counts = [
        read_star_or_mart(spark, root, name).agg(F.lit(name).alias("table_name"), F.count("*").alias("row_count"))
        for name in names
    ]
    summary = counts[0]
    for count in counts[1:]:
        summary = summary.unionByName(count)
    return summary
