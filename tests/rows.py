"""Rows written by hand."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import types as T

from farelake.schemas import FACT_TRIP, TRIP_V2

NTZ = T.TimestampNTZType()


def wall_clock(schema: T.StructType) -> T.StructType:
    return T.StructType(
        [T.StructField(f.name, NTZ if f.dataType == T.TimestampType() else f.dataType, True) for f in schema]
    )


GOOD = {
    "VendorID": 1,
    "tpep_pickup_datetime": datetime(2025, 3, 1, 10, 0, 0),
    "tpep_dropoff_datetime": datetime(2025, 3, 1, 10, 20, 0),
    "passenger_count": 2,
    "trip_distance": 3.25,
    "RatecodeID": 1,
    "store_and_fwd_flag": "N",
    "PULocationID": 10,
    "DOLocationID": 20,
    "payment_type": 1,
    "fare_amount": 15.5,
    "extra": 1.0,
    "mta_tax": 0.5,
    "tip_amount": 2.0,
    "tolls_amount": 0.0,
    "improvement_surcharge": 1.0,
    "total_amount": 20.0,
    "congestion_surcharge": 2.5,
    "Airport_fee": 0.0,
    "cbd_congestion_fee": 0.75,
}


def trips(spark, *changes: dict):
    rows = [tuple({**GOOD, **change}[name] for name in TRIP_V2.names) for change in changes]
    return spark.createDataFrame(rows, wall_clock(TRIP_V2))


FACT = {
    "fact_trip_sk": 0,
    "pickup_time_sk": datetime(2025, 3, 1, 10, 0, 0),
    "dropoff_time_sk": datetime(2025, 3, 1, 10, 20, 0),
    "vendor_sk": 1,
    "ratecode_sk": 1,
    "payment_type_sk": 1,
    "pickup_location_sk": 10,
    "dropoff_location_sk": 20,
    "passenger_count": 2,
    "trip_distance_miles": 3.25,
    "store_and_fwd_flag": "N",
    "fare_amount": 15.5,
    "extra": 1.0,
    "mta_tax": 0.5,
    "tip_amount": 2.0,
    "tolls_amount": 0.0,
    "improvement_surcharge": 1.0,
    "total_amount": 20.0,
    "congestion_surcharge": 2.5,
    "airport_fee": 0.0,
    "cbd_congestion_fee": 0.75,
    "trip_time_seconds": 1200,
    "created_at_sk": datetime(2025, 3, 1, 10, 0, 0),
}


def facts(spark, *changes: dict):
    rows = [tuple({**FACT, **change}[name] for name in FACT_TRIP.names) for change in changes]
    return spark.createDataFrame(rows, wall_clock(FACT_TRIP))


def day(n: int) -> datetime:
    return datetime(2025, 3, 1, 10) + timedelta(days=n)


def zones(spark, ids):
    rows = [(i, f"B{i % 3}", f"Z{i}", "S") for i in ids]
    return spark.createDataFrame(rows, "location_id int, borough string, zone string, service_zone string")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def same_rows(a, b) -> bool:
    from collections import Counter

    return sorted(a.columns) == sorted(b.columns) and Counter(a.select(*sorted(a.columns)).collect()) == Counter(
        b.select(*sorted(a.columns)).collect()
    )
