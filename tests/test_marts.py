import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from rows import day, facts, plan_of, same_rows, zones

from farelake.operators import marts, star
from farelake.schemas import MART_TABLES, assert_contract


@pytest.fixture(scope="module")
def fact(spark):
    rows = [
        {
            "pickup_time_sk": datetime(2025, 1 + i % 3, 1 + i % 27, i % 24, i % 60),
            "vendor_sk": [1, 2, None][i % 3],
            "payment_type_sk": 1 + i % 7,
            "pickup_location_sk": [10, 11, 12, None][i % 4],
            "dropoff_location_sk": [20, 21, None][i % 3],
            "total_amount": 10 + i % 90 / 100,
            "tip_amount": i % 7 / 4,
            "trip_time_seconds": 100 + i,
        }
        for i in range(400)
    ]
    return facts(spark, *rows).cache()


@pytest.fixture(scope="module")
def dims(spark):
    return star.dim_vendor(spark), star.dim_payment(spark), zones(spark, [10, 11, 12, 20, 21])


def direct(fact, vendors, payments, locations, times=None):
    return {
        "agg_daily_trips": marts.daily_trips(fact, times),
        "agg_hourly_patterns": marts.hourly_patterns(fact, times),
        "agg_pickup_locations": marts.pickup_locations(fact, locations),
        "agg_dropoff_locations": marts.dropoff_locations(fact, locations),
        "agg_vendor_performance": marts.vendor_performance(fact, vendors, times),
        "agg_payment_analysis": marts.payment_analysis(fact, payments, times),
        "agg_popular_routes": marts.popular_routes(fact, locations),
        "agg_revenue_breakdown": marts.revenue_breakdown(fact, times),
    }


@pytest.mark.parametrize("name", MART_TABLES)
def test_mart_keeps_its_contract_however_it_is_built(spark, fact, dims, name):
    times = star.dim_time(fact, "pickup_time_sk", "dropoff_time_sk")
    alone = direct(fact, *dims)[name]
    assert_contract(alone, MART_TABLES[name], name)
    assert same_rows(alone, direct(fact, *dims, times)[name])
    for rollup in (marts.time_rollup(fact), marts.time_rollup(fact, times)):
        shared = marts.all_marts(rollup, marts.route_rollup(fact), *dims)[name]
        assert_contract(shared, MART_TABLES[name], name)
        assert same_rows(alone, shared)


def test_trip_counts_agree(fact, dims):
    def trips(name, column):
        return direct(fact, *dims)[name].agg(F.sum(column)).head()[0]

    assert trips("agg_daily_trips", "total_trips") == 400
    assert trips("agg_revenue_breakdown", "total_trips") == 400
    assert trips("agg_pickup_locations", "pickup_count") == 400
    assert trips("agg_popular_routes", "trip_count") == 400


def test_unmatched_keys_share_the_null_group(spark):
    fact = facts(spark, {}, {"pickup_location_sk": None}, {"pickup_location_sk": 77}, {"pickup_location_sk": 78})
    rows = {r.location_id: r for r in marts.pickup_locations(fact, zones(spark, [10])).collect()}
    assert rows[None].pickup_count == 3
    assert rows[None].total_revenue == 60.0
    assert rows[None].popularity_rank == 1
    assert rows[10].pickup_count == 1
    route = marts.popular_routes(fact, zones(spark, [20])).head()
    assert (route.pickup_location_id, route.dropoff_location_id, route.trip_count) == (None, 20, 4)


def test_repeated_dimension_rows_multiply_as_a_join_does(spark):
    fact = facts(spark, {}, {"total_amount": 30.0})
    mart = marts.pickup_locations(fact, zones(spark, [10, 10])).head()
    assert (mart.pickup_count, mart.total_revenue, mart.avg_fare) == (4, 100.0, 25.0)


def test_trip_without_pickup_time_counts_under_null(spark):
    fact = facts(spark, {}, {"pickup_time_sk": None})
    rows = {r.date: r for r in marts.daily_trips(fact).collect()}
    assert rows[None].total_trips == 1
    assert rows[None].is_weekend is None
    hours = {r.hour: r for r in marts.hourly_patterns(fact).collect()}
    assert (hours[None].day_of_week, hours[None].is_weekend) == (None, None)


def test_moving_average_takes_rows_not_days(spark):
    days = [0, 1, 5, 6, 7, 8, 9, 10, 11]
    rows = [{"pickup_time_sk": day(d), "total_amount": float(d + 1)} for d in days for _ in range(d + 1)]
    got = marts.daily_trips(facts(spark, *rows)).collect()
    trips = [d + 1 for d in days]
    revenue = [float((d + 1) ** 2) for d in days]
    for i, row in enumerate(got):
        span = slice(max(0, i - 6), i + 1)
        assert row.moving_avg_trips_7d == round(sum(trips[span]) / len(trips[span]) + 1e-9, 2)
        assert row.moving_avg_revenue_7d == round(sum(revenue[span]) / len(revenue[span]) + 1e-9, 2)


def test_ties_at_the_last_rank_are_kept(spark, monkeypatch):
    monkeypatch.setattr(marts, "TOP_ROUTES", 2)
    counts = {10: 3, 11: 2, 12: 2, 13: 2, 14: 1}
    fact = facts(spark, *[{"pickup_location_sk": z} for z, n in counts.items() for _ in range(n)])
    mart = marts.popular_routes(fact, zones(spark, [*counts, 20]))
    got = sorted((r.pickup_location_id, r.route_rank) for r in mart.collect())
    assert got == [(10, 1), (11, 2), (12, 2), (13, 2)]
    assert "WindowGroupLimit" in plan_of(mart)


def test_vendor_rank_restarts_every_day(spark):
    rows = [{"vendor_sk": 1}] * 3 + [{"vendor_sk": 2}] * 2
    rows += [{"vendor_sk": v, "pickup_time_sk": day(1)} for v in (1, 2)]
    mart = marts.vendor_performance(facts(spark, *rows), star.dim_vendor(spark)).collect()
    assert [(r.vendor_id, r.daily_rank) for r in mart[:2]] == [(1, 1), (2, 2)]
    assert [r.daily_rank for r in mart[2:]] == [1, 1]


@pytest.mark.parametrize(
    "amounts, average",
    [
        ([0.01, 0.02], 0.02),
        ([1.01, 1.02], 1.02),
        ([2.67, 2.68], 2.68),
        ([0.1, 0.2, 0.3], 0.2),
        ([-1.01, -1.02], -1.02),
        ([0.004, 0.004], 0.0),
        ([1.004, 1.008], 1.01),
        ([1e17, 3e17], 2e17),
        ([5.0, None], 5.0),
        ([None, None], None),
    ],
)
def test_average_rounds_half_up(spark, amounts, average):
    fact = facts(spark, *[{"total_amount": a} for a in amounts])
    row = marts.daily_trips(fact).head()
    assert row.avg_fare == average
    if all(a is None for a in amounts):
        assert row.total_revenue is None


def test_not_a_number_stays_visible(spark):
    row = marts.daily_trips(facts(spark, {}, {"total_amount": math.nan})).head()
    assert math.isnan(row.total_revenue) and math.isnan(row.avg_fare)
    row = marts.daily_trips(facts(spark, {}, {"total_amount": math.inf})).head()
    assert row.total_revenue == math.inf


def test_sums_do_not_depend_on_partitioning(spark):
    fact = spark.range(200_000).select(
        F.lit(datetime(2025, 3, 1)).cast("timestamp_ntz").alias("pickup_time_sk"),
        ((F.col("id") * 7919) % 1_000_003 / 100).alias("total_amount"),
        F.lit(0.1).alias("trip_distance_miles"),
        F.lit(1).cast("bigint").alias("trip_time_seconds"),
        F.lit(0.07).alias("tip_amount"),
        F.lit(1).alias("passenger_count"),
    )
    exact = sum((i * 7919) % 1_000_003 for i in range(200_000))
    for parts in (1, 3, 64):
        row = marts.daily_trips(fact.repartition(parts)).head()
        assert row.total_revenue == exact / 100
        assert row.total_tips == 14000.0
        assert row.avg_distance == 0.1


def test_no_trips_give_empty_marts(spark, dims):
    for name, mart in direct(facts(spark, {}).limit(0), *dims).items():
        assert mart.count() == 0, name


def test_marts_aggregate_before_they_shuffle_and_use_no_python(fact, dims):
    for name, mart in direct(fact, *dims).items():
        plan = plan_of(mart)
        assert "Python" not in plan, name
        assert "partial_count(1)" in plan, name


def test_hot_keys(spark, dims):
    rows = spark.range(300_000).select((F.col("id") % 3).alias("h"), "id")
    base = facts(spark, {}).drop("pickup_location_sk", "pickup_time_sk")
    hot = rows.crossJoin(F.broadcast(base)).select(
        "*",
        F.when(F.col("h") == 0, 10).otherwise((F.col("id") % 9000).cast("int")).alias("pickup_location_sk"),
        F.lit(datetime(2025, 3, 1)).cast("timestamp_ntz").alias("pickup_time_sk"),
    )
    mart = marts.pickup_locations(hot, dims[2])
    assert mart.filter("location_id = 10").head().pickup_count >= 100_000
    assert mart.agg(F.sum("pickup_count")).head()[0] == 300_000
