"""Marts kept up to date, counts taken while writing, tables that are replaced, clustered and densely keyed."""

import shutil
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from rows import facts, same_rows, trips, zones

import farelake.__main__ as jobs
from farelake.operators.keys import with_dense_key
from farelake.plans import batch, loads
from farelake.schemas import MART_TABLES, SORT_KEYS
from farelake.sinks import tables
from farelake.sinks.tables import read_star_or_mart, standing, write_parquet, write_star_or_mart


def day(k, **more):
    start = datetime(2025, 3, 1 + k % 7, k % 24, k % 60)
    end = start + timedelta(minutes=5 + k % 40)
    return {"tpep_pickup_datetime": start, "tpep_dropoff_datetime": end, "total_amount": 5.0 + k % 13} | {
        "PULocationID": 1 + k % 20,
        "VendorID": 1 + k % 2,
    } | more


ROWS = [day(k) for k in range(300)]


@pytest.fixture(scope="module")
def whole(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("whole"))
    batch.run_batch_on(spark, trips(spark, *ROWS), zones(spark, range(1, 30)), root)
    return root


def load(spark, root, rows, name):
    return loads.load_trips(spark, trips(spark, *rows), zones(spark, range(1, 30)), str(root), name)


def marts_equal(spark, root, whole):
    for name in (*MART_TABLES, "dim_time"):
        assert same_rows(loads.read_loaded(spark, str(root), name), read_star_or_mart(spark, whole, name)), name


def test_two_loads_give_the_marts_of_one(spark, whole, tmp_path):
    rows = load(spark, tmp_path, ROWS[:170], "a")
    assert rows["fact_trip"] == 170
    # The second load reads nothing of the first but its states: its fact and times are away meanwhile.
    hidden = {}
    for name in loads.LOADED:
        hidden[name] = tmp_path / f"away-{name}"
        shutil.move(tmp_path / name / "load=a", hidden[name])
    rows = load(spark, tmp_path, ROWS[170:], "b")
    for name in loads.LOADED:
        shutil.move(hidden[name], tmp_path / name / "load=a")
    assert rows["fact_trip"] == 130
    marts_equal(spark, tmp_path, whole)
    assert rows["agg_daily_trips"] == 7


def test_a_load_that_runs_again_replaces_itself(spark, whole, tmp_path):
    load(spark, tmp_path, ROWS[:100] + ROWS[:30], "a")
    load(spark, tmp_path, ROWS[170:], "b")
    load(spark, tmp_path, ROWS[:170], "a")
    marts_equal(spark, tmp_path, whole)
    load(spark, tmp_path, ROWS[:9], "c")
    loads.drop_load(spark, str(tmp_path), "c")
    marts_equal(spark, tmp_path, whole)


def test_names_of_loads(spark, tmp_path):
    with pytest.raises(ValueError, match="a/b"):
        load(spark, tmp_path, ROWS[:1], "a/b")


def test_batch_job_with_a_load(spark, tmp_path, capsys):
    trips(spark, *ROWS[:5]).write.parquet(str(tmp_path / "trips"))
    (tmp_path / "z.csv").write_text("LocationID,Borough,Zone,service_zone\n10,B,Z,S\n")
    jobs.main(
        ["--time-zone", "UTC", "batch", "--load", "2025-03", "--mixed-types"]
        + ["--trips", str(tmp_path / "trips"), "--zones", str(tmp_path / "z.csv"), "--root", str(tmp_path / "dw")]
    )
    assert "agg_popular_routes" in capsys.readouterr().out
    assert loads.read_loaded(spark, str(tmp_path / "dw"), "fact_trip").count() == 5


def test_counts_are_taken_while_writing(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "run_summary", lambda *a: pytest.fail("tables are read again"))
    run = batch.run_batch_on(spark, trips(spark, *ROWS), zones(spark, range(1, 30)), str(tmp_path))
    counts = {r.table_name: r.row_count for r in run.summary.collect()}
    assert counts == {name: read_star_or_mart(spark, run.root, name).count() for name in counts}
    assert len(counts) == 14


def test_counts_of_empty_partitioned_and_appended_tables(spark, tmp_path):
    rows = spark.createDataFrame([(k, "ab"[k % 2]) for k in range(10)], "v int, p string")
    assert write_parquet(rows.where("v < 0"), str(tmp_path / "none"), ["v"]) == 0
    assert write_parquet(rows, str(tmp_path / "parts"), ["v"], ["p"]) == 10
    assert write_parquet(rows, str(tmp_path / "parts"), ["v"], ["p"], replace="partitions") == 10
    assert write_parquet(rows, str(tmp_path / "plain"), mode="append") == 10


def test_a_crash_between_the_two_renames(spark, tmp_path):
    path = tmp_path / "dim_vendor"
    vendors = spark.createDataFrame([(1, "a")], "vendor_id int, provider_name string")
    write_star_or_mart(vendors, str(tmp_path), "dim_vendor")
    path.rename(tmp_path / "dim_vendor.old-0")
    assert standing(spark, str(path)).endswith("dim_vendor.old-0")
    assert read_star_or_mart(spark, str(tmp_path), "dim_vendor").count() == 1
    broken = vendors.withColumn("provider_name", F.raise_error(F.lit("no")).cast("string"))
    with pytest.raises(Exception, match="no"):
        write_star_or_mart(broken, str(tmp_path), "dim_vendor")
    assert [p.name for p in tmp_path.iterdir()] == ["dim_vendor"]
    path.rename(tmp_path / "dim_vendor.old-1")
    write_star_or_mart(vendors.unionAll(vendors), str(tmp_path), "dim_vendor")
    assert read_star_or_mart(spark, str(tmp_path), "dim_vendor").count() == 2
    assert [p.name for p in tmp_path.iterdir()] == ["dim_vendor"]


def test_dense_key_is_row_number_for_any_partitioning(spark):
    rows = facts(spark, *[{"pickup_time_sk": datetime(2025, 3, 1, k % 5), "total_amount": float(k % 40)} for k in range(400)])
    order = SORT_KEYS["fact_trip"]
    found = [
        sorted(map(tuple, with_dense_key(rows.repartition(n), "fact_trip_sk", order).collect())) for n in (1, 3, 16)
    ]
    rows.createOrReplaceTempView("dense")
    others = [c for c in rows.columns if c not in (*order, "fact_trip_sk")]
    numbered = spark.sql(
        f"SELECT row_number() OVER (ORDER BY {', '.join([*order, *others])}) - 1 AS fact_trip_sk, "
        f"* EXCEPT (fact_trip_sk) FROM dense"
    ).select(rows.columns)
    want = sorted(map(tuple, numbered.collect()))
    assert found[0] == found[1] == found[2] == want
    assert [r[0] for r in want] == list(range(400))


def test_dense_key_of_one_row_many_times_and_of_none(spark):
    rows = facts(spark, {}).withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(50_000)))).drop("n")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        keyed = with_dense_key(rows.repartition(8), "fact_trip_sk", SORT_KEYS["fact_trip"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    keys = keyed.select(F.min("fact_trip_sk"), F.max("fact_trip_sk"), F.countDistinct("fact_trip_sk")).head()
    assert tuple(keys) == (0, 49_999, 50_000)
    # The one row is dealt to more than one range.
    assert keyed.rdd.glom().filter(len).count() > 1
    assert with_dense_key(rows.limit(0), "fact_trip_sk", SORT_KEYS["fact_trip"]).count() == 0


def scanned(df):
    """Rows that come out of the scans of a plan that ran."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec" else plan
    leaves = plan.collectLeaves()
    return sum(leaves.apply(k).metrics().apply("numOutputRows").value() for k in range(leaves.size()))


def test_clustered_files_are_skipped_by_time(spark, tmp_path):
    start = datetime(2024, 1, 1)
    rows = spark.range(36_000).select(
        F.timestamp_add("MINUTE", (F.col("id") * 7919 % 518_400).cast("int"), F.lit(start)).alias("pickup_time_sk")
    )
    rows = rows.withColumns({"dropoff_time_sk": F.col("pickup_time_sk"), "vendor_sk": F.lit(1)}).repartition(12)
    order = SORT_KEYS["fact_trip"]
    spark.conf.set("spark.sql.shuffle.partitions", "12")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_parquet(rows, str(tmp_path / "plain"), order)
        write_parquet(rows, str(tmp_path / "clustered"), order, clustered=True)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    month = "pickup_time_sk >= timestamp '2024-05-01' AND pickup_time_sk < timestamp '2024-06-01'"
    found = [spark.read.parquet(str(tmp_path / n)).where(month) for n in ("plain", "clustered")]
    assert same_rows(*found)
    plain, clustered = (scanned(spark.read.parquet(str(tmp_path / n)).where(month)) for n in ("plain", "clustered"))
    assert plain == 36_000 and clustered <= 36_000 * 3 / 12


def test_a_hot_second_is_clustered_into_several_files(spark, tmp_path):
    rows = spark.range(20_000).select(F.lit(datetime(2025, 3, 1)).alias("t"), F.col("id"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_parquet(rows, str(tmp_path / "t"), ["t"], clustered=True)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = [spark.read.parquet(str(p)).count() for p in (tmp_path / "t").glob("*.parquet")]
    assert len(sizes) >= 3 and max(sizes) < 10_000
