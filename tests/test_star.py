import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from rows import facts, plan_of, same_rows, trips, zones

from farelake.operators import joins, star
from farelake.operators.clean import clean_trips
from farelake.schemas import (
    DIM_LOCATION,
    DIM_PAYMENT,
    DIM_RATECODE,
    DIM_TIME,
    DIM_VENDOR,
    FACT_TRIP,
    ContractError,
    assert_contract,
)


def lookups(spark):
    return star.dim_vendor(spark), star.dim_ratecode(spark), star.dim_payment(spark)


def test_literal_dimensions(spark):
    vendor, rate, payment = lookups(spark)
    assert [vendor.count(), rate.count(), payment.count()] == [2, 7, 6]
    assert_contract(vendor, DIM_VENDOR)
    assert_contract(rate, DIM_RATECODE)
    assert_contract(payment, DIM_PAYMENT)
    assert "LocalTableScan" in plan_of(vendor)


def test_location_dimension(spark):
    raw = spark.createDataFrame(
        [("1", "EWR", "Newark", "EWR")], "LocationID string, Borough string, Zone string, service_zone string"
    )
    dim = star.dim_location(raw)
    assert_contract(dim, DIM_LOCATION)
    assert tuple(dim.head()) == (1, "EWR", "Newark", "EWR")


def test_time_dimension_is_the_deduplicated_union_of_both_columns(spark):
    rows = trips(
        spark,
        {},
        {},
        {"tpep_pickup_datetime": datetime(2025, 3, 1, 10, 20)},
        {"tpep_dropoff_datetime": None},
        {"tpep_pickup_datetime": datetime(2025, 3, 8, 23, 59, 59)},
    )
    both = star.build_dim_time(rows, "tpep_pickup_datetime").unionByName(
        star.build_dim_time(rows, "tpep_dropoff_datetime")
    )
    times = star.dim_time(rows)
    assert_contract(times, DIM_TIME)
    assert same_rows(times, both.dropDuplicates())
    saturday = times.filter("timestamp_id = TIMESTAMP_NTZ'2025-03-08 23:59:59'").head()
    assert tuple(saturday)[2:] == (2025, 3, 8, 23, 59, "Sat", 1)
    assert plan_of(times).count("Exchange") == 1


def test_fact_row(spark):
    fact = star.fact_trip(clean_trips(trips(spark, {"RatecodeID": 8})), *lookups(spark), zones(spark, [10]))
    assert_contract(fact, FACT_TRIP)
    row = fact.head()
    assert row.ratecode_sk == 99
    assert row.trip_time_seconds == 1200
    assert row.pickup_location_sk == 10
    assert row.dropoff_location_sk is None
    assert row.created_at_sk == row.pickup_time_sk == datetime(2025, 3, 1, 10)


def test_fact_without_time_join_equals_the_star_join(spark):
    clean = clean_trips(
        trips(spark, *[{"tpep_pickup_datetime": datetime(2025, 3, 1, 9, i), "VendorID": i % 2 + 1} for i in range(50)])
    )
    args = (*lookups(spark), zones(spark, range(1, 15)))
    derived = star.fact_trip(clean, *args).drop("fact_trip_sk")
    joined = star.fact_trip(clean, *args, times=star.dim_time(clean)).drop("fact_trip_sk")
    assert derived.count() == 50
    assert same_rows(derived, joined)


def test_trips_are_not_shuffled(spark, tmp_path):
    trips(spark, {}).write.parquet(str(tmp_path / "t"))
    clean = clean_trips(spark.read.parquet(str(tmp_path / "t")))
    plan = plan_of(star.fact_trip(clean, *lookups(spark), zones(spark, [10])))
    assert plan.count("BroadcastHashJoin") == 5
    shuffled = re.findall(r"Exchange hashpartitioning\((\w+)#", plan)
    assert set(shuffled) <= {"vendor_sk", "rate_sk", "payment_type_sk", "location_id"}


def test_surrogate_key_is_unique(spark):
    rows = clean_trips(trips(spark, *[{}] * 40)).repartition(4)
    fact = star.fact_trip(rows, *lookups(spark), zones(spark, [10, 20]))
    assert fact.select("fact_trip_sk").distinct().count() == 40


def test_lookup_beyond_the_bound_is_not_broadcast(spark):
    large = spark.range(0, 30, 1, 2)
    assert "broadcast" in joins.broadcast_if_small(large, 30)._jdf.queryExecution().toString()
    assert "broadcast" not in joins.broadcast_if_small(large, 29)._jdf.queryExecution().toString()


def test_large_location_table_gives_the_same_fact(spark, monkeypatch):
    clean = clean_trips(trips(spark, *[{"PULocationID": i} for i in range(1, 30)]))
    dim = zones(spark, range(5, 300))
    small = star.fact_trip(clean, *lookups(spark), dim).drop("fact_trip_sk")
    monkeypatch.setattr(joins, "broadcast_if_small", lambda d: d)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shuffled = star.fact_trip(clean, *lookups(spark), dim).drop("fact_trip_sk")
        assert "SortMergeJoin" in plan_of(shuffled)
        assert same_rows(small, shuffled)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_contract_names_the_difference(spark):
    with pytest.raises(ContractError, match="vendor_id"):
        assert_contract(star.dim_vendor(spark).drop("vendor_id"), DIM_VENDOR, "dim_vendor")
    with pytest.raises(ContractError, match="order"):
        assert_contract(star.dim_vendor(spark).select("provider_name", "vendor_id"), DIM_VENDOR)
    assert_contract(facts(spark, {}), FACT_TRIP)


def test_repeated_lookup_rows_do_not_multiply_trips(spark):
    clean = clean_trips(trips(spark, {}, {"VendorID": 2}))
    twice = [d.unionByName(d) for d in (*lookups(spark), zones(spark, [10, 20]))]
    assert same_rows(
        star.fact_trip(clean, *twice).drop("fact_trip_sk"),
        star.fact_trip(clean, *lookups(spark), zones(spark, [10, 20])).drop("fact_trip_sk"),
    )


def test_joins_whose_keys_are_unused_are_left_out(spark, tmp_path):
    trips(spark, {}).write.parquet(str(tmp_path / "t"))
    clean = clean_trips(spark.read.parquet(str(tmp_path / "t")))
    fact = star.fact_trip(clean, *lookups(spark), zones(spark, [10]))
    assert "Join" not in plan_of(fact.groupBy("pickup_time_sk").sum("total_amount"))
    assert plan_of(fact.groupBy("vendor_sk").sum("total_amount")).count("BroadcastHashJoin") == 1


def skewed(spark, tmp_path, name, change):
    """Stored trips of which a third has one key, under thresholds that call them skewed."""
    rows = spark.range(60_000).selectExpr("id", "if(id % 3 = 0, 0, id % 5000) AS k")
    base = trips(spark, {}).drop(name)
    out = rows.crossJoin(base).withColumn(name, change).drop("id", "k")
    out.repartition(6).write.parquet(str(tmp_path / "t"))
    return clean_trips(spark.read.parquet(str(tmp_path / "t")))


SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "8",
}


@pytest.fixture
def small_skew(spark):
    before = {k: spark.conf.get(k, None) for k in SKEW}
    for k, v in SKEW.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_second_is_split(spark, tmp_path, small_skew):
    second = F.expr("timestamp_ntz'2025-03-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, k)")
    clean = skewed(spark, tmp_path, "tpep_pickup_datetime", second)
    clean = clean.withColumn("tpep_dropoff_datetime", F.expr("tpep_pickup_datetime + interval 5 minutes"))
    star.dim_time(clean).write.parquet(str(tmp_path / "times"))
    fact = star.fact_trip(clean, *lookups(spark), zones(spark, [10, 20]), spark.read.parquet(str(tmp_path / "times")))
    assert "skew=true" in final_plan(fact.groupBy("pickup_time_sk").sum("total_amount"))


def test_hot_lookup_beyond_the_bound_is_split(spark, tmp_path, small_skew, monkeypatch):
    monkeypatch.setattr(joins, "broadcast_if_small", lambda d: d)
    clean = skewed(spark, tmp_path, "PULocationID", F.expr("cast(1 + k % 200 as int)"))
    zones(spark, range(1, 264)).write.parquet(str(tmp_path / "z"))
    fact = star.fact_trip(clean, *lookups(spark), spark.read.parquet(str(tmp_path / "z")))
    assert "skew=true" in final_plan(fact.groupBy("pickup_location_sk").sum("total_amount"))
