"""Trip messages from Kafka; needs the spark-sql-kafka package on the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def kafka_options(
    servers: str, topic: str, starting_offsets: str = "latest", max_offsets_per_trigger: int | None = None
) -> dict[str, str]:
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting_offsets}
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def read_kafka(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting_offsets: str = "latest",
    max_offsets_per_trigger: int | None = None,
) -> DataFrame:
    """Topic as a stream. By default a first start reads new messages only."""
    options = kafka_options(servers, topic, starting_offsets, max_offsets_per_trigger)
    return spark.readStream.format("kafka").options(**options).load()
