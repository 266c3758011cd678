"""Trip files of different physical types read as one table."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F
from rows import same_rows, trips

from farelake.operators.clean import conform_trips
from farelake.sources import files


def stored(df, path, n=1):
    df.coalesce(n).write.parquet(str(path))


@pytest.fixture
def months(spark, tmp_path):
    """Four months: doubles and bigints, ints, text times of version 1, and ints again."""
    root = tmp_path / "trips"
    rows = [trips(spark, {"total_amount": 10.0 + k, "VendorID": 1 + k % 2, "passenger_count": None if k == 1 else k + 1}) for k in range(4)]
    wide = rows[0].withColumns({"VendorID": F.col("VendorID").cast("bigint"), "passenger_count": F.col("passenger_count").cast("double")})
    stored(wide.drop("cbd_congestion_fee"), root / "m1")
    stored(rows[1], root / "m2")
    stored(rows[2].withColumn("VendorID", F.col("VendorID").cast("bigint")), root / "m3")
    stored(rows[3], root / "m4")
    return root, rows


def test_months_of_different_types_are_one_table(spark, months):
    root, rows = months
    found = files.read_trips(spark, str(root), mixed=True)
    want = conform_trips(rows[0].withColumn("cbd_congestion_fee", F.lit(None).cast("double")))
    for other in rows[1:]:
        want = want.unionByName(conform_trips(other))
    assert found.schema == want.schema and same_rows(found, want)


def test_plain_reading_can_not_do_that(spark, months):
    root, _ = months
    with pytest.raises(Exception):
        conform_trips(spark.read.parquet(*[str(p) for p in sorted(root.iterdir())])).collect()


def test_alike_files_make_one_group(spark, months):
    root, _ = months
    names = [str(p) for p in root.rglob("*.parquet")]
    groups = files.alike_files(spark, names)
    assert sorted(len(names) for _, names in groups) == [1, 1, 2]
    assert sorted(n for _, names in groups for n in names) == sorted(names)


def test_few_jobs_for_many_files_of_two_types(spark, tmp_path, monkeypatch):
    for k in range(16):
        df = trips(spark, {"VendorID": 1})
        stored(df.withColumn("VendorID", F.col("VendorID").cast("bigint")) if k < 9 else df, tmp_path / f"m{k:02}")
    calls = []
    once = files._together
    monkeypatch.setattr(files, "_together", lambda spark, names: calls.append(len(names)) or once(spark, names))
    groups = files.alike_files(spark, [str(p) for p in tmp_path.rglob("*.parquet")])
    assert sorted(len(names) for _, names in groups) == [7, 9]
    assert len(calls) <= 9


def test_text_times_join_wall_clock_times(spark, tmp_path):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    stored(trips(spark, {"VendorID": 1}), tmp_path / "a")
    text = trips(spark, {"VendorID": 2}).withColumns(
        {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("tpep_pickup_datetime", "tpep_dropoff_datetime")}
    )
    stored(text, tmp_path / "b")
    found = files.read_trips(spark, str(tmp_path), mixed=True)
    times = found.select(F.date_format("tpep_pickup_datetime", "yyyy-MM-dd HH:mm:ss")).distinct().collect()
    assert [t[0] for t in times] == ["2025-03-01 10:00:00"] and found.count() == 2


def test_a_column_that_no_file_has_is_an_error(spark, tmp_path):
    stored(trips(spark, {}).drop("extra"), tmp_path / "a")
    with pytest.raises(ValueError, match="extra"):
        files.read_trips(spark, str(tmp_path), mixed=True)
    (tmp_path / "empty").mkdir()
    with pytest.raises(ValueError, match="no trip files"):
        files.read_trips(spark, str(tmp_path / "empty"), mixed=True)


def test_names_with_spaces_and_signs(spark, tmp_path):
    stored(trips(spark, {"VendorID": 1}), tmp_path / "a b%20c+d")
    assert files.read_trips(spark, str(tmp_path), mixed=True).count() == 1


def test_replay_takes_files_of_types_not_seen_before(spark, months, tmp_path):
    root, rows = months
    seen = []

    def replay():
        names = files.replay_file_names(spark, str(root), max_files=1, latest_first=False)
        write = files.mixed_batches(lambda df, i: seen.extend((i, r.total_amount) for r in df.collect()))
        names.writeStream.foreachBatch(write).option("checkpointLocation", str(tmp_path / "cp")).trigger(
            availableNow=True
        ).start().awaitTermination()

    replay()
    assert sorted(a for _, a in seen) == [10.0, 11.0, 12.0, 13.0] and len({i for i, _ in seen}) == 4
    late = trips(spark, {"total_amount": 99.0, "tpep_pickup_datetime": datetime(2025, 3, 1)})
    stored(late.withColumn("payment_type", F.col("payment_type").cast("double")), root / "m5")
    replay()
    assert seen[-1][1] == 99.0 and len(seen) == 5
