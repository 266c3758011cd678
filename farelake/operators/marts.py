"""The eight aggregate marts.

Each mart first reduces the fact to an additive state on a few integer keys, which Spark combines
before the shuffle, so hot dates, zones or vendors cost nothing extra. Names and descriptions are
joined to the reduced rows, and rows whose key matches no dimension row merge into the NULL group.

``all_marts`` derives all eight from two roll-ups whose size is bounded by the calendar and the
number of zones, not by the trips: the fact is read twice rather than once per mart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelake.functions.calendar import calendar, day_flags
from farelake.functions.exact import Measures, mean, total
from farelake.operators.windows import moving_average, moving_average_money, rank_desc, top_ranked

TOP_ROUTES = 1000
MOVING_ROWS = 7

DAILY = Measures(
    totals=("total_amount", "tip_amount"),
    means=("total_amount", "trip_distance_miles", "trip_time_seconds", "passenger_count"),
    extremes=("total_amount",),
)
HOURLY = Measures(means=("total_amount", "trip_distance_miles", "trip_time_seconds"))
ZONES = Measures(totals=("total_amount",), means=("total_amount", "trip_distance_miles"))
VENDORS = ZONES
PAYMENTS = Measures(totals=("total_amount", "tip_amount"), means=("total_amount", "tip_amount"))
ROUTES = HOURLY
REVENUE = Measures(
    totals=(
        "total_amount",
        "fare_amount",
        "extra",
        "mta_tax",
        "tip_amount",
        "tolls_amount",
        "improvement_surcharge",
        "congestion_surcharge",
        "airport_fee",
        "cbd_congestion_fee",
    )
)

DAY_KEYS = ["date", "year", "month", "day", "is_weekend"]
HOUR_KEYS = ["hour", "day_of_week", "is_weekend"]
MONTH_KEYS = ["year", "month"]
ZONE_KEYS = ["location_id", "borough", "zone", "service_zone"]
ROUTE_KEYS = [
    "pickup_location_id",
    "pickup_borough",
    "pickup_zone",
    "dropoff_location_id",
    "dropoff_borough",
    "dropoff_zone",
]


def with_calendar(fact: DataFrame, times: DataFrame | None = None) -> DataFrame:
    """Calendar columns of the pickup time: computed in place, or joined from the time dimension."""
    if times is None:
        return fact.withColumns(calendar(F.col("pickup_time_sk")))
    return fact.join(times, fact["pickup_time_sk"] == times["timestamp_id"], "left")


def time_rollup(fact: DataFrame, times: DataFrame | None = None) -> DataFrame:
    """State per date, hour, vendor and payment type: a few hundred rows a day at most."""
    rows = with_calendar(fact, times)
    keys = ["date", "hour", "vendor_sk", "payment_type_sk"]
    needed = DAILY | HOURLY | VENDORS | PAYMENTS | REVENUE
    if times is None:
        return needed.of_rows(rows, keys).withColumns(day_flags(F.col("date")))
    return needed.of_rows(rows, [*keys, "year", "month", "day", "day_of_week", "is_weekend"])


def route_rollup(fact: DataFrame) -> DataFrame:
    """State per pair of zones: at most zones squared rows."""
    return (ROUTES | ZONES).of_rows(fact, ["pickup_location_sk", "dropoff_location_sk"])


def _daily(state: DataFrame) -> DataFrame:
    days = state.select(
        *DAY_KEYS,
        F.col("n").alias("total_trips"),
        total("total_amount").alias("total_revenue"),
        mean("trip_distance_miles").alias("avg_distance"),
        mean("trip_time_seconds").alias("avg_duration_seconds"),
        mean("total_amount").alias("avg_fare"),
        total("tip_amount").alias("total_tips"),
        mean("passenger_count").alias("avg_passengers"),
        F.col("total_amount__max").alias("max_fare"),
        F.col("total_amount__min").alias("min_fare"),
    )
    return days.withColumns(
        {
            "moving_avg_trips_7d": moving_average("total_trips", "date", MOVING_ROWS),
            "moving_avg_revenue_7d": moving_average_money("total_revenue", "date", MOVING_ROWS),
        }
    ).orderBy("date")


def _hourly(state: DataFrame) -> DataFrame:
    return state.select(
        *HOUR_KEYS,
        F.col("n").alias("total_trips"),
        mean("total_amount").alias("avg_fare"),
        mean("trip_distance_miles").alias("avg_distance"),
        mean("trip_time_seconds").alias("avg_duration_seconds"),
    ).orderBy("is_weekend", "hour")


def _by_zone(state: DataFrame, locations: DataFrame, role: str) -> DataFrame:
    key, count = f"{role}_location_sk", f"{role}_count"
    named = state.join(locations, state[key] == locations["location_id"], "left")
    return (
        ZONES.of_states(named, ZONE_KEYS)
        .select(
            *ZONE_KEYS,
            F.col("n").alias(count),
            mean("total_amount").alias("avg_fare"),
            mean("trip_distance_miles").alias("avg_distance"),
            total("total_amount").alias("total_revenue"),
        )
        .withColumn("popularity_rank", rank_desc(count))
        .orderBy(F.col(count).desc())
    )


def _by_vendor(state: DataFrame, vendors: DataFrame) -> DataFrame:
    keys = ["date", "vendor_id", "provider_name"]
    named = state.join(vendors, state["vendor_sk"] == vendors["vendor_id"], "left")
    return (
        VENDORS.of_states(named, keys)
        .select(
            *keys,
            F.col("n").alias("daily_trips"),
            total("total_amount").alias("daily_revenue"),
            mean("trip_distance_miles").alias("avg_distance"),
            mean("total_amount").alias("avg_fare"),
        )
        .withColumn("daily_rank", rank_desc("daily_trips", "date"))
        .orderBy("date", "daily_rank")
    )


def _by_payment(state: DataFrame, payments: DataFrame) -> DataFrame:
    keys = [*MONTH_KEYS, "payment_id", "payment_type_name"]
    named = state.join(payments, state["payment_type_sk"] == payments["payment_id"], "left")
    return (
        PAYMENTS.of_states(named, keys)
        .select(
            *keys,
            F.col("n").alias("transaction_count"),
            total("total_amount").alias("total_revenue"),
            total("tip_amount").alias("total_tips"),
            mean("total_amount").alias("avg_transaction"),
            mean("tip_amount").alias("avg_tip"),
        )
        .orderBy("year", "month", F.col("transaction_count").desc())
    )


def _by_route(state: DataFrame, locations: DataFrame) -> DataFrame:
    def ends(role: str) -> DataFrame:
        return locations.select(
            F.col("location_id").alias(f"{role}_location_id"),
            F.col("borough").alias(f"{role}_borough"),
            F.col("zone").alias(f"{role}_zone"),
        )

    named = state.join(ends("pickup"), F.col("pickup_location_sk") == F.col("pickup_location_id"), "left").join(
        ends("dropoff"), F.col("dropoff_location_sk") == F.col("dropoff_location_id"), "left"
    )
    routes = ROUTES.of_states(named, ROUTE_KEYS).select(
        *ROUTE_KEYS,
        F.col("n").alias("trip_count"),
        mean("trip_distance_miles").alias("avg_distance"),
        mean("trip_time_seconds").alias("avg_duration_seconds"),
        mean("total_amount").alias("avg_fare"),
    )
    return top_ranked(routes, "trip_count", TOP_ROUTES, "route_rank")


def _revenue(state: DataFrame) -> DataFrame:
    return state.select(
        *MONTH_KEYS,
        F.col("n").alias("total_trips"),
        total("fare_amount").alias("total_base_fare"),
        total("extra").alias("total_extra"),
        total("mta_tax").alias("total_mta_tax"),
        total("tip_amount").alias("total_tips"),
        total("tolls_amount").alias("total_tolls"),
        total("improvement_surcharge").alias("total_improvement_surcharge"),
        total("congestion_surcharge").alias("total_congestion_surcharge"),
        total("airport_fee").alias("total_airport_fee"),
        total("cbd_congestion_fee").alias("total_cbd_fee"),
        total("total_amount").alias("total_revenue"),
    ).orderBy(*MONTH_KEYS)


def daily_trips(fact: DataFrame, times: DataFrame | None = None) -> DataFrame:
    """Trips, revenue and averages per day, with 7-row moving averages."""
    rows = with_calendar(fact, times)
    if times is None:
        # The date settles the other keys, so group by it alone.
        return _daily(DAILY.of_rows(rows, ["date"]).withColumns(day_flags(F.col("date"))))
    return _daily(DAILY.of_rows(rows, DAY_KEYS))


def hourly_patterns(fact: DataFrame, times: DataFrame | None = None) -> DataFrame:
    """Demand per hour of day and weekday."""
    rows = with_calendar(fact, times)
    if times is None:
        # Group by the weekday's number; its name is attached to the 168 results.
        names = F.array(*[F.lit(d) for d in ("Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun")])
        state = HOURLY.of_rows(rows.withColumn("weekday", F.weekday("pickup_time_sk")), ["hour", "weekday"])
        return _hourly(
            state.withColumns(
                {
                    "day_of_week": F.get(names, F.col("weekday")),
                    "is_weekend": (F.col("weekday") >= 5).cast("tinyint"),
                }
            )
        )
    return _hourly(HOURLY.of_rows(rows, HOUR_KEYS))


def zone_popularity(fact: DataFrame, locations: DataFrame, role: str) -> DataFrame:
    """Trips and fares per zone and its popularity rank; ``role`` is ``pickup`` or ``dropoff``."""
    return _by_zone(ZONES.of_rows(fact, [f"{role}_location_sk"]), locations, role)


def pickup_locations(fact: DataFrame, locations: DataFrame) -> DataFrame:
    return zone_popularity(fact, locations, "pickup")


def dropoff_locations(fact: DataFrame, locations: DataFrame) -> DataFrame:
    return zone_popularity(fact, locations, "dropoff")


def vendor_performance(fact: DataFrame, vendors: DataFrame, times: DataFrame | None = None) -> DataFrame:
    """Trips and revenue per vendor and day, vendors ranked within the day."""
    return _by_vendor(VENDORS.of_rows(with_calendar(fact, times), ["date", "vendor_sk"]), vendors)


def payment_analysis(fact: DataFrame, payments: DataFrame, times: DataFrame | None = None) -> DataFrame:
    """Transactions, revenue and tips per month and payment type."""
    return _by_payment(PAYMENTS.of_rows(with_calendar(fact, times), [*MONTH_KEYS, "payment_type_sk"]), payments)


def popular_routes(fact: DataFrame, locations: DataFrame) -> DataFrame:
    """The 1000 most frequent routes, ties at the last rank included."""
    return _by_route(ROUTES.of_rows(fact, ["pickup_location_sk", "dropoff_location_sk"]), locations)


def revenue_breakdown(fact: DataFrame, times: DataFrame | None = None) -> DataFrame:
    """Revenue components per month."""
    return _revenue(REVENUE.of_rows(with_calendar(fact, times), MONTH_KEYS))


def all_marts(
    by_time: DataFrame, by_route: DataFrame, vendors: DataFrame, payments: DataFrame, locations: DataFrame
) -> dict[str, DataFrame]:
    """All eight marts from ``time_rollup`` and ``route_rollup``."""
    return {
        "agg_daily_trips": _daily(DAILY.of_states(by_time, DAY_KEYS)),
        "agg_hourly_patterns": _hourly(HOURLY.of_states(by_time, HOUR_KEYS)),
        "agg_pickup_locations": _by_zone(by_route, locations, "pickup"),
        "agg_dropoff_locations": _by_zone(by_route, locations, "dropoff"),
        "agg_vendor_performance": _by_vendor(by_time, vendors),
        "agg_payment_analysis": _by_payment(by_time, payments),
        "agg_popular_routes": _by_route(by_route, locations),
        "agg_revenue_breakdown": _revenue(REVENUE.of_states(by_time, MONTH_KEYS)),
    }
