"""Trips per time window, on a stream or on a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
WINDOW_KEYS = ["window_ts"]


def with_event_time(trips: DataFrame, source: str = "tpep_pickup_datetime", name: str = "pickup_ts") -> DataFrame:
    """Event time from text or a wall-clock column, read in the session's time zone."""
    return trips.withColumn(name, F.to_timestamp(source))


def window_counts(
    events: DataFrame, event_time: str = "pickup_ts", width: str = "10 minutes", watermark: str | None = "30 minutes"
) -> DataFrame:
    """Rows per tumbling window.

    ``window_ts`` is the window's start as a timestamp and its unique key; the text columns are local
    time and repeat when clocks go back. Rows later than the watermark are dropped in update and append
    mode. Complete mode keeps all windows and still counts them.
    """
    if watermark is not None and events.isStreaming:
        events = events.withWatermark(event_time, watermark)
    return (
        events.groupBy(F.window(event_time, width).alias("w"))
        .agg(F.count("*").alias("trip_count"))
        .select(
            F.col("w.start").alias("window_ts"),
            F.date_format("w.start", STAMP_FORMAT).alias("window_start"),
            F.date_format("w.end", STAMP_FORMAT).alias("window_end"),
            "trip_count",
        )
    )
