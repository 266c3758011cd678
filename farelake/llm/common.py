"""What several operators share: words, stored intermediate tables, reserved column names."""

from __future__ import annotations

import atexit
import threading
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of anything but space and the control characters from tab to carriage return.
GAP = r"[\x20\x09-\x0D]+"
#: Terms are runs of letters and digits.
NO_TERM = r"[^\p{L}\p{N}]+"

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


_ROOT = str(Path(__file__).resolve().parents[2])


def find_package(spark: SparkSession) -> None:
    """Python workers look for this package where the driver found it, besides where they look anyway."""
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(":")
    if _ROOT not in paths:
        environment["PYTHONPATH"] = ":".join([_ROOT, *filter(None, paths)])


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    find_package(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def without(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """``df`` without columns whose names (in any case) an operator takes for its own."""
    taken = {name.lower() for name in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def words(text: Column) -> Column:
    """Words of a text, none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), GAP), lambda w: w != "")


def same(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)


_LOCK = threading.Lock()
#: By session, how many actions have the setting on, and what it was before the first of them.
_CLEANING: dict[int, tuple[int, str]] = {}


@contextmanager
def _files_go(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of an action go when it ends; its result has been written by then. Actions of several threads may
    overlap: the last one brings the session's own setting back."""
    with _LOCK:
        running, before = _CLEANING.get(id(spark), (0, ""))
        before = before if running else spark.conf.get(_CLEANUP, "false")
        _CLEANING[id(spark)] = running + 1, before
        spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        with _LOCK:
            running, before = _CLEANING.pop(id(spark))
            if running > 1:
                _CLEANING[id(spark)] = running - 1, before
            else:
                spark.conf.set(_CLEANUP, before)


def scratch(spark: SparkSession) -> str:
    """Folder for this application's intermediate tables: below ``spark.checkpoint.dir``, which the whole cluster
    shares, or below the warehouse where that is unset. It goes when the program ends."""
    conf = spark.sparkContext.getConf()
    root = spark.conf.get("spark.checkpoint.dir", None) or conf.get("spark.checkpoint.dir")
    root = root or spark.conf.get("spark.sql.warehouse.dir")
    folder = f"{root.rstrip('/')}/farelake-llm-{spark.sparkContext.applicationId}"
    if folder not in _KNOWN:
        _KNOWN.add(folder)
        atexit.register(_remove, spark, folder)
    return folder


_KNOWN: set[str] = set()


def _remove(spark: SparkSession, folder: str) -> None:
    context = spark.sparkContext
    if context._jsc is None or context._jsc.sc().isStopped():
        return
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back: it is computed once, a lost executor costs no more
    than its running tasks, and joins on it can be split where a key is frequent."""
    spark = df.sparkSession
    path = f"{scratch(spark)}/{name}-{uuid.uuid4().hex}"
    with _files_go(spark):
        df.write.option("compression", "zstd").parquet(path)
    _MADE.paths.append(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._stored_at = path
    return table


class _Made(threading.local):
    """Tables that this thread has stored and that a block may delete."""

    def __init__(self) -> None:
        self.paths: list[str] = []


_MADE = _Made()


@contextmanager
def steps(spark: SparkSession) -> Iterator[list[DataFrame]]:
    """Tables that this thread stores inside of the block go at its end, but for those from ``stored`` that the block
    puts into the list; all go if the block fails."""
    kept: list[DataFrame] = []
    outer, _MADE.paths = _MADE.paths, []
    stay: list[str] = []
    try:
        yield kept
        stay = [table._stored_at for table in kept]
    finally:
        for path in set(_MADE.paths) - set(stay):
            _remove(spark, path)
        _MADE.paths = outer + stay


def sampled(labels: DataFrame, rows: int) -> DataFrame:
    """One label for each id, of ``rows`` ids at most: those with the smallest hashes, whatever the order of the table.
    Ids far beyond the bound are left out before they are sorted, so one task sees little more than the sample."""
    labels = labels.where(F.col("doc_id").isNotNull()).dropDuplicates(["doc_id"])
    total = labels.count()
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    if total > rows:
        labels = labels.where(draw < int((1 << 30) * min(1.0, 1.2 * rows / total + 0.001)))
    return stored(labels.orderBy(draw, "doc_id").limit(rows), "sample")


def ranked(df: DataFrame, by: list[str]) -> DataFrame:
    """``df`` with ``rank``, its rows counted from 0 in the order of ``by`` (nulls first): a range shuffle, then the
    rows before each partition, of which there is one number a partition."""
    spark = df.sparkSession
    ordered = df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_m", F.monotonically_increasing_id())
    parts = stored(ordered, "ordered").withColumn("_part", F.shiftright("_m", 33))
    before = 0
    starts = []
    for row in parts.groupBy("_part").count().orderBy("_part").collect():
        starts.append((row["_part"], before))
        before += row["count"]
    offsets = spark.createDataFrame(starts, "_part long, _start long")
    rank = F.col("_start") + F.col("_m").bitwiseAND((1 << 33) - 1)
    return parts.join(F.broadcast(offsets), "_part").withColumn("rank", rank).drop("_part", "_m", "_start")


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join that shuffles both sides whatever their sizes: nothing that grows with the input is
    broadcast, and AQE splits frequent keys."""
    return df.hint("merge")
