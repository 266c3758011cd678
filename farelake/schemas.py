"""Table contracts: trips, star schema, marts, and the sort key of every stored table."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import types as T

_INT, _LONG, _BYTE = T.IntegerType(), T.LongType(), T.ByteType()
_DBL, _FLT, _STR = T.DoubleType(), T.FloatType(), T.StringType()
_TS, _NTZ, _DATE = T.TimestampType(), T.TimestampNTZType(), T.DateType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


# The twenty trip fields of both message versions.
TRIP_V2 = _struct(
    ("VendorID", _INT),
    ("tpep_pickup_datetime", _TS),
    ("tpep_dropoff_datetime", _TS),
    ("passenger_count", _LONG),
    ("trip_distance", _DBL),
    ("RatecodeID", _LONG),
    ("store_and_fwd_flag", _STR),
    ("PULocationID", _INT),
    ("DOLocationID", _INT),
    ("payment_type", _LONG),
    ("fare_amount", _DBL),
    ("extra", _DBL),
    ("mta_tax", _DBL),
    ("tip_amount", _DBL),
    ("tolls_amount", _DBL),
    ("improvement_surcharge", _DBL),
    ("total_amount", _DBL),
    ("congestion_surcharge", _DBL),
    ("Airport_fee", _DBL),
    ("cbd_congestion_fee", _DBL),
)

# Version 1 differs: text timestamps, int counts and codes, float money, lower-case airport_fee.
TRIP_V1 = T.StructType(
    [
        T.StructField(
            f.name.replace("Airport", "airport"),
            _STR if f.dataType == _TS else _INT if f.dataType == _LONG else _FLT if f.dataType == _DBL else f.dataType,
            True,
        )
        for f in TRIP_V2
    ]
)

ZONE_CSV = _struct(("LocationID", _STR), ("Borough", _STR), ("Zone", _STR), ("service_zone", _STR))

# The tables of the star schema and of the marts, and their sort keys.
DIM_TIME = _struct(
    ("timestamp_id", _TS),
    ("date", _DATE),
    ("year", _INT),
    ("month", _INT),
    ("day", _INT),
    ("hour", _INT),
    ("minute", _INT),
    ("day_of_week", _STR),
    ("is_weekend", _BYTE),
)
DIM_VENDOR = _struct(("vendor_id", _INT), ("provider_name", _STR))
DIM_PAYMENT = _struct(("payment_id", _INT), ("payment_type_name", _STR), ("description", _STR))
DIM_RATECODE = _struct(("rate_code_id", _INT), ("rate_code_name", _STR), ("description", _STR))
DIM_LOCATION = _struct(("location_id", _INT), ("borough", _STR), ("zone", _STR), ("service_zone", _STR))
FACT_TRIP = _struct(
    ("fact_trip_sk", _LONG),
    ("pickup_time_sk", _TS),
    ("dropoff_time_sk", _TS),
    ("vendor_sk", _INT),
    ("ratecode_sk", _INT),
    ("payment_type_sk", _INT),
    ("pickup_location_sk", _INT),
    ("dropoff_location_sk", _INT),
    ("passenger_count", _INT),
    ("trip_distance_miles", _DBL),
    ("store_and_fwd_flag", _STR),
    ("fare_amount", _DBL),
    ("extra", _DBL),
    ("mta_tax", _DBL),
    ("tip_amount", _DBL),
    ("tolls_amount", _DBL),
    ("improvement_surcharge", _DBL),
    ("total_amount", _DBL),
    ("congestion_surcharge", _DBL),
    ("airport_fee", _DBL),
    ("cbd_congestion_fee", _DBL),
    ("trip_time_seconds", _LONG),
    ("created_at_sk", _TS),
)

DAILY_TRIPS = _struct(
    ("date", _DATE),
    ("year", _INT),
    ("month", _INT),
    ("day", _INT),
    ("is_weekend", _BYTE),
    ("total_trips", _LONG),
    ("total_revenue", _DBL),
    ("avg_distance", _DBL),
    ("avg_duration_seconds", _DBL),
    ("avg_fare", _DBL),
    ("total_tips", _DBL),
    ("avg_passengers", _DBL),
    ("max_fare", _DBL),
    ("min_fare", _DBL),
    ("moving_avg_trips_7d", _DBL),
    ("moving_avg_revenue_7d", _DBL),
)
HOURLY_PATTERNS = _struct(
    ("hour", _INT),
    ("day_of_week", _STR),
    ("is_weekend", _BYTE),
    ("total_trips", _LONG),
    ("avg_fare", _DBL),
    ("avg_distance", _DBL),
    ("avg_duration_seconds", _DBL),
)


def _zone_mart(count: str) -> T.StructType:
    return _struct(
        ("location_id", _INT),
        ("borough", _STR),
        ("zone", _STR),
        ("service_zone", _STR),
        (count, _LONG),
        ("avg_fare", _DBL),
        ("avg_distance", _DBL),
        ("total_revenue", _DBL),
        ("popularity_rank", _INT),
    )


PICKUP_LOCATIONS = _zone_mart("pickup_count")
DROPOFF_LOCATIONS = _zone_mart("dropoff_count")
VENDOR_PERFORMANCE = _struct(
    ("date", _DATE),
    ("vendor_id", _INT),
    ("provider_name", _STR),
    ("daily_trips", _LONG),
    ("daily_revenue", _DBL),
    ("avg_distance", _DBL),
    ("avg_fare", _DBL),
    ("daily_rank", _INT),
)
PAYMENT_ANALYSIS = _struct(
    ("year", _INT),
    ("month", _INT),
    ("payment_id", _INT),
    ("payment_type_name", _STR),
    ("transaction_count", _LONG),
    ("total_revenue", _DBL),
    ("total_tips", _DBL),
    ("avg_transaction", _DBL),
    ("avg_tip", _DBL),
)
POPULAR_ROUTES = _struct(
    ("pickup_location_id", _INT),
    ("pickup_borough", _STR),
    ("pickup_zone", _STR),
    ("dropoff_location_id", _INT),
    ("dropoff_borough", _STR),
    ("dropoff_zone", _STR),
    ("trip_count", _LONG),
    ("avg_distance", _DBL),
    ("avg_duration_seconds", _DBL),
    ("avg_fare", _DBL),
    ("route_rank", _INT),
)
REVENUE_BREAKDOWN = _struct(
    ("year", _INT),
    ("month", _INT),
    ("total_trips", _LONG),
    ("total_base_fare", _DBL),
    ("total_extra", _DBL),
    ("total_mta_tax", _DBL),
    ("total_tips", _DBL),
    ("total_tolls", _DBL),
    ("total_improvement_surcharge", _DBL),
    ("total_congestion_surcharge", _DBL),
    ("total_airport_fee", _DBL),
    ("total_cbd_fee", _DBL),
    ("total_revenue", _DBL),
)

STAR_TABLES = {
    "dim_time": DIM_TIME,
    "dim_vendor": DIM_VENDOR,
    "dim_payment": DIM_PAYMENT,
    "dim_ratecode": DIM_RATECODE,
    "dim_location": DIM_LOCATION,
    "fact_trip": FACT_TRIP,
}
MART_TABLES = {
    "agg_daily_trips": DAILY_TRIPS,
    "agg_hourly_patterns": HOURLY_PATTERNS,
    "agg_pickup_locations": PICKUP_LOCATIONS,
    "agg_dropoff_locations": DROPOFF_LOCATIONS,
    "agg_vendor_performance": VENDOR_PERFORMANCE,
    "agg_payment_analysis": PAYMENT_ANALYSIS,
    "agg_popular_routes": POPULAR_ROUTES,
    "agg_revenue_breakdown": REVENUE_BREAKDOWN,
}
TABLES = STAR_TABLES | MART_TABLES

SORT_KEYS = {
    "dim_time": ["timestamp_id"],
    "dim_vendor": ["vendor_id"],
    "dim_payment": ["payment_id"],
    "dim_ratecode": ["rate_code_id"],
    "dim_location": ["location_id"],
    "fact_trip": ["pickup_time_sk", "dropoff_time_sk", "vendor_sk"],
    "agg_daily_trips": ["year", "month", "day"],
    "agg_hourly_patterns": ["is_weekend", "hour"],
    "agg_pickup_locations": ["popularity_rank"],
    "agg_dropoff_locations": ["popularity_rank"],
    "agg_vendor_performance": ["date", "vendor_id"],
    "agg_payment_analysis": ["year", "month", "payment_id"],
    "agg_popular_routes": ["route_rank"],
    "agg_revenue_breakdown": ["year", "month"],
}


class ContractError(ValueError):
    """A DataFrame does not have the columns its table promises."""


def assert_contract(df: DataFrame, contract: T.StructType, name: str = "table") -> DataFrame:
    """Return ``df`` if its column names, order and types are those of ``contract``.

    A zone-free timestamp satisfies a timestamp column: Parquet trip files carry wall-clock times.
    """

    def shape(schema: T.StructType) -> list[tuple[str, str]]:
        return [(f.name, (_TS if f.dataType == _NTZ else f.dataType).simpleString()) for f in schema]

    have, want = shape(df.schema), shape(contract)
    if have != want:
        wrong = sorted(set(have) ^ set(want)) or "column order"
        raise ContractError(f"{name}: schema differs from its contract at {wrong}")
    return df


def avro_schema(trip: T.StructType, record: str = "Trip") -> str:
    """Avro schema text of a trip struct: every field a nullable union, timestamps in millis."""
    names = {_INT: "int", _LONG: "long", _DBL: "double", _FLT: "float", _STR: "string"}
    millis = {"type": "long", "logicalType": "timestamp-millis"}
    fields = [
        {"name": f.name, "type": ["null", millis if f.dataType == _TS else names[f.dataType]], "default": None}
        for f in trip
    ]
    return json.dumps({"type": "record", "name": record, "fields": fields})
