from datetime import datetime

import pytest
from pyspark.sql import functions as F
from rows import GOOD, plan_of, same_rows, trips

from farelake.operators import clean
from farelake.operators.clean import clean_trips, conform_trips
from farelake.schemas import TRIP_V1, TRIP_V2

AT = datetime(2025, 3, 1, 10)


def kept(spark, **change) -> bool:
    return clean.clean_trips(trips(spark, change)).count() == 1


def test_good_trip_is_kept(spark):
    assert kept(spark)


@pytest.mark.parametrize(
    "column",
    [*clean.REQUIRED, *clean.POSITIVE],
)
def test_null_in_a_needed_column_drops_the_trip(spark, column):
    assert not kept(spark, **{column: None})


@pytest.mark.parametrize(
    "change",
    [
        {"tpep_dropoff_datetime": AT},
        {"tpep_dropoff_datetime": datetime(2025, 3, 1, 9)},
        {"passenger_count": 0},
        {"passenger_count": -1},
        {"trip_distance": 0.0},
        {"fare_amount": 0.0},
        {"fare_amount": -5.0},
        {"total_amount": 0.0},
        {"VendorID": 0},
        {"VendorID": 3},
        {"PULocationID": 0},
        {"PULocationID": 264},
        {"DOLocationID": 0},
        {"DOLocationID": 264},
    ],
)
def test_bad_trip_is_dropped(spark, change):
    assert not kept(spark, **change)


@pytest.mark.parametrize("change", [{"PULocationID": 1}, {"PULocationID": 263}, {"DOLocationID": 263}, {"VendorID": 2}])
def test_trip_at_the_edge_is_kept(spark, change):
    assert kept(spark, **change)


@pytest.mark.parametrize("code, repaired", [(1, 1), (6, 6), (7, 99), (0, 99), (99, 99), (None, 99)])
def test_rate_code(spark, code, repaired):
    assert clean.clean_trips(trips(spark, {"RatecodeID": code})).head().RatecodeID == repaired


@pytest.mark.parametrize("code, repaired", [(1, 1), (6, 6), (0, 5), (7, 5)])
def test_payment_type(spark, code, repaired):
    assert clean.clean_trips(trips(spark, {"payment_type": code})).head().payment_type == repaired


def test_seven_fees_are_filled_and_the_surcharge_is_not(spark):
    fees = [*clean.ZERO_IF_NULL, "improvement_surcharge"]
    row = clean.clean_trips(trips(spark, dict.fromkeys(fees))).head()
    assert [row[c] for c in clean.ZERO_IF_NULL] == [0.0] * 7
    assert row.improvement_surcharge is None


def test_cleansing_twice_changes_nothing(spark):
    raw = trips(spark, {}, {"RatecodeID": 9}, {"payment_type": 0}, {"extra": None}, {"VendorID": 7})
    once = clean.clean_trips(raw)
    assert same_rows(once, clean.clean_trips(once))


def test_old_message_version_becomes_the_trip_schema(spark):
    old = dict(GOOD) | {
        "tpep_pickup_datetime": "2025-03-01 10:00:00",
        "tpep_dropoff_datetime": "2025-03-01 10:20:00",
    }
    old["airport_fee"] = old.pop("Airport_fee")
    df = spark.createDataFrame([tuple(old[n] for n in TRIP_V1.names)], TRIP_V1)
    conformed = clean.conform_trips(df)
    assert conformed.schema == TRIP_V2
    assert clean.clean_trips(conformed).count() == 1


def test_literal_rules_reach_the_parquet_reader(spark, tmp_path):
    trips(spark, {}, {"VendorID": 4}).write.parquet(str(tmp_path / "t"))
    cleansed = clean.clean_trips(clean.conform_trips(spark.read.parquet(str(tmp_path / "t"))))
    plan = cleansed._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    pushed = next(line for line in plan.splitlines() if "PushedFilters" in line)
    for part in ("IsNotNull(payment_type)", "GreaterThan(trip_distance,0.0)", "In(VendorID, [1,2])"):
        assert part in pushed
    assert "Exchange" not in plan_of(cleansed)


def test_only_null_fees_are_filled(spark):
    fees = {"tip_amount": float("nan"), "extra": None}
    row = clean_trips(trips(spark, fees)).head()
    assert row.tip_amount != row.tip_amount and row.extra == 0.0


def test_missing_column_is_named(spark):
    with pytest.raises(ValueError, match="VendorID"):
        conform_trips(trips(spark, {}).drop("VendorID"))


def test_single_precision_money_keeps_its_digits(spark):
    old = trips(spark, {"total_amount": 12.34}).withColumn("total_amount", F.col("total_amount").cast("float"))
    assert conform_trips(old).head().total_amount == 12.34
