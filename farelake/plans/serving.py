"""Serving layer: the dashboard queries over the two outputs of the speed layer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from farelake.functions.exact import money_parts
from farelake.sinks.upsert import read_upserted

ENRICHED_VIEW = "yellow_taxi_raw"
COUNTS_VIEW = "yellow_window10min"


def register_views(spark: SparkSession, enriched: str, counts: str | None = None) -> None:
    """Make the stored stream outputs available to SQL."""
    spark.read.parquet(enriched).createOrReplaceTempView(ENRICHED_VIEW)
    windows = read_upserted(spark, counts) if counts else None
    if windows is not None:
        windows.createOrReplaceTempView(COUNTS_VIEW)


def total_trips(spark: SparkSession) -> DataFrame:
    return spark.sql(f"SELECT count(*) AS num_trip FROM {ENRICHED_VIEW}")


def window_series(spark: SparkSession) -> DataFrame:
    return spark.sql(f"SELECT window_start, trip_count FROM {COUNTS_VIEW}")


def trips_by_vendor(spark: SparkSession) -> DataFrame:
    return spark.sql(
        f"""
        SELECT VendorID AS vendorid, count(*) AS trip_count
        FROM {ENRICHED_VIEW}
        GROUP BY VendorID
        """
    )


def revenue_by_dropoff(spark: SparkSession) -> DataFrame:
    # Group by the number and turn it into text afterwards: the same groups, a cheaper key.
    cents, rest = money_parts("total_amount")
    return spark.sql(
        f"""
        SELECT cast(DOLocationID AS string) AS doid, (sum({cents}) + 100 * sum({rest})) / 100 AS total_revenue
        FROM {ENRICHED_VIEW}
        GROUP BY DOLocationID
        """
    )


def distance_and_tip(spark: SparkSession) -> DataFrame:
    return spark.sql(f"SELECT trip_distance, tip_amount FROM {ENRICHED_VIEW}")
