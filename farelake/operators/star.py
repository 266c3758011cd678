"""Dimension tables and the trip fact."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.functions.calendar import calendar, seconds_between
from farelake.operators.clean import UNKNOWN_RATE
from farelake.operators.joins import distinct_keys
from farelake.schemas import DIM_PAYMENT, DIM_RATECODE, DIM_VENDOR, FACT_TRIP
from farelake.sources.static import static_dim

# Fixed values of the lookup tables.
VENDOR_ROWS = [
    (1, "Creative Mobile Technologies"),
    (2, "VeriFone Inc"),
]
PAYMENT_ROWS = [
    (1, "Credit card", "Paid by credit card"),
    (2, "Cash", "Cash payment"),
    (3, "No charge", "No charge"),
    (4, "Dispute", "Disputed fare"),
    (5, "Unknown", "Unknown"),
    (6, "Voided trip", "Voided trip"),
]
RATECODE_ROWS = [
    (1, "Standard rate", "Standard metered fare"),
    (2, "JFK", "Flat fare to/from JFK Airport"),
    (3, "Newark", "Fare to/from Newark Airport"),
    (4, "Nassau/Westchester", "Outside NYC"),
    (5, "Negotiated", "Negotiated fare"),
    (6, "Group ride", "Group/shared ride"),
    (99, "Unknown", "Unknown rate"),
]


def dim_vendor(spark: SparkSession) -> DataFrame:
    return static_dim(spark, VENDOR_ROWS, DIM_VENDOR)


def dim_payment(spark: SparkSession) -> DataFrame:
    return static_dim(spark, PAYMENT_ROWS, DIM_PAYMENT)


def dim_ratecode(spark: SparkSession) -> DataFrame:
    return static_dim(spark, RATECODE_ROWS, DIM_RATECODE)


def dim_location(zones: DataFrame) -> DataFrame:
    """Zone lookup rows -> location dimension."""
    return zones.select(
        F.col("LocationID").cast("int").alias("location_id"),
        F.col("Borough").alias("borough"),
        F.col("Zone").alias("zone"),
        F.col("service_zone").alias("service_zone"),
    )


def _time_rows(stamps: DataFrame) -> DataFrame:
    return stamps.withColumns(calendar(F.col("timestamp_id")))


def build_dim_time(df: DataFrame, column: str) -> DataFrame:
    """One row per distinct non-NULL timestamp of ``column``, with its calendar attributes."""
    stamps = df.select(F.col(column).alias("timestamp_id")).filter(F.col("timestamp_id").isNotNull())
    return _time_rows(stamps.distinct())


def dim_time(
    trips: DataFrame, pickup: str = "tpep_pickup_datetime", dropoff: str = "tpep_dropoff_datetime"
) -> DataFrame:
    """Every timestamp at which a trip starts or ends, once.

    Equal to the deduplicated union of ``build_dim_time`` over both columns, but the input is read
    once and shuffled once, and the attributes are computed after the duplicates are gone.
    """
    stamps = trips.select(F.explode(F.array(pickup, dropoff)).alias("timestamp_id"))
    return _time_rows(stamps.filter(F.col("timestamp_id").isNotNull()).distinct())


def fact_trip(
    trips: DataFrame,
    vendors: DataFrame,
    ratecodes: DataFrame,
    payments: DataFrame,
    locations: DataFrame,
    times: DataFrame | None = None,
) -> DataFrame:
    """Cleansed trips -> fact rows: each key is the dimension's key, NULL where none matches.

    The time dimension holds exactly the trips' own timestamps, so a timestamp is its own key and needs
    no join. Pass ``times`` to join a stored time dimension all the same: two shuffles of the fact. Stored,
    because AQE splits a hot second only where nothing but the shuffle stands between table and join.

    Keys of broadcast lookups are made distinct first. A repeated row then cannot multiply trips, and Spark
    leaves out the joins whose keys a query does not use.
    """
    keys = distinct_keys
    zones = keys(locations, "location_id", "location_id")
    # The codes are cast, not the lookup keys: Spark must see the bare distinct key to leave out a join.
    vendor, rate, payment = (F.col(c).cast("int") for c in ("VendorID", "RatecodeID", "payment_type"))
    joined = (
        trips.join(keys(vendors, "vendor_id", "vendor_sk"), vendor == F.col("vendor_sk"), "left")
        .join(keys(ratecodes, "rate_code_id", "rate_sk"), rate == F.col("rate_sk"), "left")
        .join(keys(payments, "payment_id", "payment_type_sk"), payment == F.col("payment_type_sk"), "left")
        .join(zones.alias("pu"), F.col("PULocationID") == F.col("pu.location_id"), "left")
        .join(zones.alias("do"), F.col("DOLocationID") == F.col("do.location_id"), "left")
    )
    pickup, dropoff = F.col("tpep_pickup_datetime"), F.col("tpep_dropoff_datetime")
    pickup_key, dropoff_key = pickup, dropoff
    if times is not None:
        stamps = times.select("timestamp_id")
        joined = joined.join(stamps.alias("pt"), pickup == F.col("pt.timestamp_id"), "left").join(
            stamps.alias("dt"), dropoff == F.col("dt.timestamp_id"), "left"
        )
        pickup_key, dropoff_key = F.col("pt.timestamp_id"), F.col("dt.timestamp_id")

    special = {
        "fact_trip_sk": F.monotonically_increasing_id(),
        "pickup_time_sk": pickup_key,
        "dropoff_time_sk": dropoff_key,
        "ratecode_sk": F.coalesce(F.col("rate_sk"), F.lit(UNKNOWN_RATE)),
        "pickup_location_sk": F.col("pu.location_id"),
        "dropoff_location_sk": F.col("do.location_id"),
        "trip_distance_miles": F.col("trip_distance"),
        "trip_time_seconds": seconds_between(pickup, dropoff),
        "created_at_sk": pickup,
    }

    def output(field):
        column = special.get(field.name, F.col(field.name))
        # Timestamps keep their kind; everything else takes the type of the contract.
        if field.dataType.typeName() != "timestamp":
            column = column.cast(field.dataType)
        return column.alias(field.name)

    return joined.select(*[output(f) for f in FACT_TRIP])
