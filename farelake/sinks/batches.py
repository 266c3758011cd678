"""Appending a stream's batches to files, each once however often it runs."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from hashlib import sha256

from pyspark.sql import DataFrame, SparkSession

_AQE = "spark.sql.adaptive.enabled"


@contextmanager
def adaptive(spark: SparkSession) -> Iterator[None]:
    """Spark turns adaptive execution off in a stream's session; what a batch writes is an ordinary query."""
    before = spark.conf.get(_AQE)
    spark.conf.set(_AQE, "true")
    try:
        yield
    finally:
        spark.conf.set(_AQE, before)


def _delete(spark: SparkSession, pattern: str) -> None:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    fs = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for found in fs.globStatus(hadoop) or []:
        fs.delete(found.getPath(), False)


def _refuse_file_sink(spark: SparkSession, path: str) -> None:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/_spark_metadata")
    if hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
        raise ValueError(f"readers of {path} see only what Spark's file sink has logged there: choose another folder")


def append_once(
    path: str,
    checkpoint: str,
    partition_by: Sequence[str] = (),
    max_records: int | None = None,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
) -> Callable[[DataFrame, int], None]:
    """Per-batch function for ``foreachBatch``: adds the batch, after ``prepare``, to the Parquet files at ``path``.

    Files carry the stream (its checkpoint folder) and the batch in their names. A batch that runs again after a failure
    first deletes the files that its earlier attempt left, so nothing is there twice. Only the first batch after a start
    can be such a one, so only then are the folders searched. Streams with other checkpoints don't meet. A folder that
    Spark's own file sink has written to is refused, as readers would not see what is added.
    """
    stream = sha256(checkpoint.rstrip("/").encode()).hexdigest()[:8]
    started = False

    def write(batch: DataFrame, batch_id: int) -> None:
        nonlocal started
        spark, name = batch.sparkSession, f"stream-{stream}-{batch_id:09d}"
        if not started:
            _refuse_file_sink(spark, path)
            _delete(spark, "/".join([path.rstrip("/"), *["*"] * len(partition_by), f"{name}-*"]))
        rows = prepare(batch) if prepare else batch
        writer = rows.write.mode("append").option("mapreduce.output.basename", name)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        if max_records:
            writer = writer.option("maxRecordsPerFile", max_records)
        with adaptive(spark):
            writer.parquet(path)
        started = True

    return write
