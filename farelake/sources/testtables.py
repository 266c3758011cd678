"""Trips and zones derived from the generic test tables, row by row and without a shuffle.

Each rule hits some rows: codes outside the valid range, missing values, trips that end before they
start, zones beyond the last one, and five zones that the zone table does not know.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def trips_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """Raw trips, one per line item, in the column order of the trip schema.

    Each field takes one or two operations, so that cleansing and this mapping still fit one compiled stage.
    """
    order, part, supp, line = (F.col(c) for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"))
    quantity, price = F.col("l_quantity"), F.col("l_extendedprice")
    start = order * 7919 % 86399  # all hours of the day
    pickup = F.timestamp_add("SECOND", start, F.col("l_shipdate"))
    dropoff = F.timestamp_add("SECOND", start + part % 3607 - 60, F.col("l_shipdate"))
    return lineitem.select(
        F.nullif(line % 4, F.lit(3)).alias("VendorID"),
        F.when(order % 101 != 0, pickup).alias("tpep_pickup_datetime"),
        F.when(part % 103 != 0, dropoff).alias("tpep_dropoff_datetime"),
        F.nullif(supp % 7, F.lit(6)).alias("passenger_count"),
        ((part % 2500).cast("double") / 100).alias("trip_distance"),
        F.nullif(part % 8, F.lit(0)).alias("RatecodeID"),
        F.col("l_returnflag").alias("store_and_fwd_flag"),
        (part % 265 + 1).cast("int").alias("PULocationID"),
        (order % 265 + 1).cast("int").alias("DOLocationID"),
        F.nullif(supp % 9, F.lit(8)).alias("payment_type"),
        (quantity - 1).alias("fare_amount"),
        F.nullif("l_discount", F.lit(0.05)).alias("extra"),
        F.nullif("l_tax", F.lit(0.08)).alias("mta_tax"),
        F.nullif(quantity, F.lit(7.0)).alias("tip_amount"),
        F.nullif("l_discount", F.lit(0.1)).alias("tolls_amount"),
        F.nullif("l_tax", F.lit(0.0)).alias("improvement_surcharge"),
        F.when(order % 59 != 0, price).otherwise(0.0).alias("total_amount"),
        F.nullif("l_tax", F.lit(0.02)).alias("congestion_surcharge"),
        F.nullif("l_discount", F.lit(0.07)).alias("Airport_fee"),
        F.nullif("l_discount", F.lit(0.01)).alias("cbd_congestion_fee"),
    )


def zones_from_part(part: DataFrame) -> DataFrame:
    """Zone lookup rows like those of the CSV file: text columns, five of the 265 zones missing."""
    zones = part.groupBy((F.col("p_partkey") % 265 + 1).alias("id")).agg(F.min("p_partkey").alias("first"))
    text = F.col("id").cast("string")
    return zones.filter(F.col("id") % 53 != 0).select(
        text.alias("LocationID"),
        F.concat(F.lit("Borough "), (F.col("first") % 6).cast("string")).alias("Borough"),
        F.concat(F.lit("Zone "), text).alias("Zone"),
        F.concat(F.lit("Service "), (F.col("first") % 4).cast("string")).alias("service_zone"),
    )
