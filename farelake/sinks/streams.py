"""Streaming sinks: append, console, landing zones and the message publisher."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from farelake.functions.keys import trip_key
from farelake.schemas import TRIP_V1, TRIP_V2, avro_schema
from farelake.sinks.batches import append_once
from farelake.sources.envelope import add_header


def triggered(writer: DataStreamWriter, interval: str | None) -> DataStreamWriter:
    """Fixed-interval trigger, or with None: work off what is there, then stop."""
    return writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)


def append_stream(
    stream: DataFrame,
    checkpoint: str,
    path: str | None = None,
    source: str = "parquet",
    interval: str | None = None,
    name: str | None = None,
    **options: str,
) -> StreamingQuery:
    """Append every row once; ``source`` is Parquet or the connector of a document store."""
    writer = stream.writeStream.outputMode("append").format(source).options(**options)
    writer = triggered(writer.option("checkpointLocation", checkpoint), interval)
    if name:
        writer = writer.queryName(name)
    return writer.start(path) if path else writer.start()


def console_stream(stream: DataFrame, interval: str | None = None, rows: int = 20) -> StreamingQuery:
    """Print the first rows of every batch, for debugging."""
    writer = stream.writeStream.outputMode("append").format("console")
    return triggered(writer.option("numRows", rows).option("truncate", "false"), interval).start()


LANDING_FOLDERS = ["year", "month", "day"]


def land_partitioned(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    interval: str | None = "10 minutes",
    max_records: int = 1_000_000,
    unordered: bool = False,
    files_per_day: int | None = None,
    pickup: str = "tpep_pickup_datetime",
) -> StreamingQuery:
    """Trips -> Parquet under year=/month=/day= of the pickup time in the session's time zone.

    A new file starts with every trigger and after ``max_records`` rows. Trips without a pickup time
    land in the default partition. With ``unordered`` a batch's rows are brought together by day first, where
    otherwise every task may write to every day: AQE merges small days into one task, of which each writes one file,
    and splits a day with much of the rows over many. ``files_per_day`` instead deals each day to that many tasks at
    most, by a hash of the whole row. A batch that runs again replaces its own files.
    """
    ts = F.col(pickup)
    formats = dict(zip(LANDING_FOLDERS, ("yyyy", "MM", "dd"), strict=True))
    days = stream.withColumns({name: F.date_format(ts, how) for name, how in formats.items()})

    def by_day(batch: DataFrame) -> DataFrame:
        folders = [F.col(name) for name in LANDING_FOLDERS]
        if not unordered:
            return batch
        if files_per_day:
            salt = F.pmod(F.xxhash64(*[F.col(c) for c in batch.columns]), F.lit(files_per_day))
            return batch.repartition(*folders, salt)
        return batch.hint("rebalance", *folders)

    write = append_once(path, checkpoint, LANDING_FOLDERS, max_records, by_day)
    writer = days.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return triggered(writer, interval).start()


def land_text(
    stream: DataFrame, path: str, checkpoint: str, interval: str | None = "10 minutes", column: str = "value"
) -> StreamingQuery:
    """The messages as text, one line each."""
    writer = stream.select(F.col(column).cast("string").alias("value")).writeStream.outputMode("append")
    return triggered(writer.format("text").option("checkpointLocation", checkpoint), interval).start(path)


def old_message_fields(trips: DataFrame) -> DataFrame:
    """The trip fields of message version 1: timestamps as text, whole numbers, single-precision money."""

    def field(new: T.StructField, old: T.StructField) -> Column:
        return F.col(new.name).cast(old.dataType).alias(old.name)

    return trips.select(*[field(new, old) for new, old in zip(TRIP_V2, TRIP_V1, strict=True)])


def encode_messages(
    trips: DataFrame,
    schema_id: int,
    encode: Callable[[Column, str], Column] | None = None,
    version: int = 2,
    schema: str | None = None,
) -> DataFrame:
    """Trips -> (key, value) messages: framed Avro records, encoded in the executors.

    ``version`` is the message version and ``schema`` its text. ``encode`` replaces the Avro writer, which needs the
    spark-avro package on the cluster.
    """
    if encode is None:
        from pyspark.sql.avro.functions import to_avro as encode
    if version == 1:
        kinds, pairs = TRIP_V1, zip(TRIP_V2, TRIP_V1, strict=True)
        record = F.struct(*[F.col(new.name).cast(old.dataType).alias(old.name) for new, old in pairs])
    else:
        kinds, record = TRIP_V2, F.struct(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in TRIP_V2])
    value = add_header(encode(record, schema or avro_schema(kinds)), schema_id)
    return trips.select(trip_key().alias("key"), value.alias("value"))


def publish_batches(
    servers: str,
    topic: str,
    schema_id: int,
    partitions: int | None = None,
    source: str = "kafka",
    encode: Callable[[Column, str], Column] | None = None,
    version: int = 2,
    schema: str | None = None,
    **options: str,
) -> Callable[[DataFrame, int], None]:
    """Per-batch function that publishes the trips of a batch and skips an empty one.

    Executors publish their own partitions; nothing passes through the driver. ``partitions`` limits
    the number of writers, the default keeps the partitioning of the batch.
    """

    def publish(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        rows = batch.repartition(partitions) if partitions else batch
        writer = encode_messages(rows, schema_id, encode, version, schema).write.format(source).mode("append")
        if source == "kafka":
            writer = writer.option("kafka.bootstrap.servers", servers).option("topic", topic)
        writer.options(**options).save()

    return publish
