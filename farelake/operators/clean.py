"""Cleansing rules. All are narrow, so they run on a stream as well as on a table."""

from __future__ import annotations

from collections.abc import Collection
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelake.schemas import TRIP_V2

# Fixed values of the cleansing rules.
REQUIRED = [
    "VendorID",
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "PULocationID",
    "DOLocationID",
    "payment_type",
]
POSITIVE = ["passenger_count", "trip_distance", "fare_amount", "total_amount"]
VENDORS = [1, 2]
RATE_CODES = [1, 2, 3, 4, 5, 6]
UNKNOWN_RATE = 99
PAYMENT_TYPES = [1, 2, 3, 4, 5, 6]
UNKNOWN_PAYMENT = 5
FIRST_ZONE, LAST_ZONE = 1, 263
ZERO_IF_NULL = [
    "Airport_fee",
    "cbd_congestion_fee",
    "congestion_surcharge",
    "extra",
    "mta_tax",
    "tolls_amount",
    "tip_amount",
]


def conform_trips(df: DataFrame, optional: Collection[str] = ()) -> DataFrame:
    """Either message version -> the one trip schema; wall-clock timestamps stay as they are. Columns of ``optional``
    (lower-case names) may be missing and are NULL then."""

    def conformed(field: T.StructField) -> Column:
        column = F.col(field.name)
        kind = next((f.dataType for f in df.schema if f.name.lower() == field.name.lower()), None)
        if kind is None and field.name.lower() in optional:
            return F.lit(None).cast(field.dataType).alias(field.name)
        if kind is None:
            raise ValueError(f"trips have no column {field.name!r}")
        if isinstance(field.dataType, T.TimestampType):
            if isinstance(kind, T.StringType):
                column = F.to_timestamp(column)
        elif kind != field.dataType:
            if isinstance(kind, T.FloatType):
                # By way of its shortest text: 12.34 stays 12.34, where widening the bits gives 12.3400001525...
                column = column.cast("string")
            column = column.cast(field.dataType)
        return column.alias(field.name)

    return df.select(*[conformed(f) for f in TRIP_V2])


def has_essentials() -> Column:
    # One IS NOT NULL per column, which the Parquet reader can push down; dropna cannot be pushed.
    return reduce(and_, [F.col(c).isNotNull() for c in REQUIRED])


def ends_after_start() -> Column:
    return F.col("tpep_pickup_datetime") < F.col("tpep_dropoff_datetime")


def has_positive_measures() -> Column:
    return reduce(and_, [F.col(c) > 0 for c in POSITIVE])


def has_known_vendor() -> Column:
    return F.col("VendorID").isin(VENDORS)


def has_known_zones() -> Column:
    return reduce(and_, [F.col(c).between(FIRST_ZONE, LAST_ZONE) for c in ("PULocationID", "DOLocationID")])


def repair_code(name: str, valid: list[int], default: int) -> Column:
    """The code if it is a known one, else ``default``; NULL counts as unknown."""
    return F.when(F.col(name).isin(valid), F.col(name)).otherwise(default)


def clean_trips(df: DataFrame) -> DataFrame:
    """Drop unusable trips, repair the two codes, fill seven NULL fees with 0."""
    kept = df.filter(
        has_essentials() & ends_after_start() & has_positive_measures() & has_known_vendor() & has_known_zones()
    )
    return kept.withColumns(
        {
            "RatecodeID": repair_code("RatecodeID", RATE_CODES, UNKNOWN_RATE),
            "payment_type": repair_code("payment_type", PAYMENT_TYPES, UNKNOWN_PAYMENT),
            # Only NULL is filled; fillna would turn NaN into 0 as well.
            **{name: F.coalesce(F.col(name), F.lit(0.0)) for name in ZERO_IF_NULL},
        }
    )
