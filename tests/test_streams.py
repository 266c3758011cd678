import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from rows import GOOD, same_rows, trips, wall_clock, zones

from farelake.functions.keys import epoch_millis, trip_key
from farelake.operators.clean import clean_trips, conform_trips
from farelake.plans import serving
from farelake.plans.stream import StreamTargets, run_stream, start_window_counts
from farelake.schemas import TRIP_V1, TRIP_V2
from farelake.session import scratch_path, zoned_session
from farelake.sinks.streams import (
    append_stream,
    console_stream,
    land_partitioned,
    land_text,
    old_message_fields,
    publish_batches,
)
from farelake.sinks.upsert import read_upserted, upsert_batches
from farelake.sources.envelope import add_header, decode_envelope, strip_header
from farelake.sources.files import read_landed_trips, replay_trips
from farelake.streaming.enrich import enrich_with_zones
from farelake.streaming.windows import WINDOW_KEYS, window_counts, with_event_time

BASE = datetime(2025, 3, 1, 12)


def write_files(spark, path, batches):
    """One file per batch, oldest first."""
    for i, changes in enumerate(batches):
        trips(spark, *changes).coalesce(1).write.mode("append").parquet(str(path))
        newest = max(path.glob("*.parquet"), key=lambda p: p.stat().st_mtime_ns)
        stamp = time.time() - 1000 + i * 10
        import os

        os.utime(newest, (stamp, stamp))


def at(minutes):
    return {"tpep_pickup_datetime": BASE + timedelta(minutes=minutes)}


# The check for late rows uses the watermark of the batch before, hence the batch in between.
LATE = [[at(0), at(5)], [at(120)], [at(130)], [at(3)], [at(140)]]


@pytest.mark.parametrize(
    "mode, counts",
    [
        ("complete", {"12:00": 3, "14:00": 1, "14:10": 1, "14:20": 1}),
        ("update", {"12:00": 2, "14:00": 1, "14:10": 1, "14:20": 1}),
        ("append", {"12:00": 2}),
    ],
)
def test_late_row_by_output_mode(spark, tmp_path, mode, counts):
    write_files(spark, tmp_path / "in", LATE)
    source = replay_trips(spark, str(tmp_path / "in"), latest_first=False)
    target = str(tmp_path / "counts")
    query = start_window_counts(source, str(tmp_path / "cp"), upsert_batches(target, WINDOW_KEYS), mode)
    query.awaitTermination()
    got = {r.window_start[11:16]: r.trip_count for r in read_upserted(spark, target).collect()}
    assert got == counts


def test_unknown_output_mode_is_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="output mode"):
        start_window_counts(trips(spark, {}), str(tmp_path), print, "sometimes")


def test_restart_continues_and_replay_changes_nothing(spark, tmp_path):
    write_files(spark, tmp_path / "in", LATE[:2])
    target = str(tmp_path / "counts")

    def run():
        source = replay_trips(spark, str(tmp_path / "in"), latest_first=False)
        write = upsert_batches(target, WINDOW_KEYS)
        start_window_counts(source, str(tmp_path / "cp"), write, "update").awaitTermination()
        return {r.window_start: r.trip_count for r in read_upserted(spark, target).collect()}

    first = run()
    assert run() == first
    write_files(spark, tmp_path / "in", [[at(121)]])
    after = run()
    assert after["2025-03-01 14:00:00"] == 2 and after["2025-03-01 12:00:00"] == 2


def test_stream_counts_equal_batch_counts(spark, tmp_path):
    rows = [[at(i * 7 % 200) for i in range(j, 60, 3)] for j in range(3)]
    write_files(spark, tmp_path / "in", rows)
    target = str(tmp_path / "counts")
    source = replay_trips(spark, str(tmp_path / "in"))
    start_window_counts(source, str(tmp_path / "cp"), upsert_batches(target, WINDOW_KEYS)).awaitTermination()
    batch = window_counts(with_event_time(spark.read.parquet(str(tmp_path / "in"))))
    assert same_rows(read_upserted(spark, target), batch)


def test_windows_of_the_repeated_hour_stay_apart(spark):
    session = zoned_session(spark, "America/New_York")
    rows = session.createDataFrame([(1762059600,), (1762063200,)], "s long").select(
        F.timestamp_seconds("s").alias("pickup_ts")
    )
    got = window_counts(rows).collect()
    assert {r.window_start for r in got} == {"2025-11-02 01:00:00"}
    assert len({r.window_ts for r in got}) == 2
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"


def test_speed_layer_counts_trips_from_unknown_zones_but_does_not_enrich_them(spark, tmp_path):
    write_files(spark, tmp_path / "in", [[{}, {"PULocationID": 99}, {"PULocationID": None}], [{"DOLocationID": 7}]])
    targets = StreamTargets(*(str(tmp_path / n) for n in ("enriched", "counts", "cp")))
    run_stream(replay_trips(spark, str(tmp_path / "in")), zones(spark, [10]), targets)
    enriched = spark.read.parquet(targets.enriched)
    assert enriched.count() == 2
    assert enriched.columns == [*TRIP_V2.names, "location_id", "borough", "zone", "service_zone"]
    assert read_upserted(spark, targets.counts).agg(F.sum("trip_count")).head()[0] == 4
    serving.register_views(spark, targets.enriched, targets.counts)
    assert serving.total_trips(spark).head().num_trip == 2
    assert serving.window_series(spark).columns == ["window_start", "trip_count"]
    assert [tuple(r) for r in serving.trips_by_vendor(spark).collect()] == [(1, 2)]
    assert {r.doid: r.total_revenue for r in serving.revenue_by_dropoff(spark).collect()} == {"20": 20.0, "7": 20.0}
    assert serving.distance_and_tip(spark).count() == 2


def test_failing_query_stops_the_other(spark, tmp_path, monkeypatch):
    write_files(spark, tmp_path / "in", [[{}]])
    from farelake.plans import stream

    def broken(target, keys, whole=False):
        def write(batch, batch_id):
            raise RuntimeError("sink is gone")

        return write

    monkeypatch.setattr(stream, "upsert_batches", broken)
    targets = StreamTargets(*(str(tmp_path / n) for n in ("enriched", "counts", "cp")))
    with pytest.raises(Exception, match="sink is gone"):
        run_stream(replay_trips(spark, str(tmp_path / "in")), zones(spark, [10]), targets, interval="1 second")
    assert spark.streams.active == []


def test_cleansing_runs_on_a_stream(spark, tmp_path):
    write_files(spark, tmp_path / "in", [[{}, {"VendorID": 9}, {"RatecodeID": None}]])
    cleansed = clean_trips(replay_trips(spark, str(tmp_path / "in")))
    append_stream(cleansed, str(tmp_path / "cp"), str(tmp_path / "out"), name="cleansed").awaitTermination()
    assert sorted(r.RatecodeID for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [1, 99]


def test_newest_file_first(spark, tmp_path):
    write_files(spark, tmp_path / "in", [[{"VendorID": 1}], [{"VendorID": 2}]])
    order = []
    for newest in (True, False):
        seen = []
        source = replay_trips(spark, str(tmp_path / "in"), latest_first=newest)
        source.writeStream.foreachBatch(lambda df, i, seen=seen: seen.append(df.head().VendorID)).option(
            "checkpointLocation", str(tmp_path / f"cp{newest}")
        ).trigger(availableNow=True).start().awaitTermination()
        order.append(seen)
    assert order == [[2, 1], [1, 2]]


@pytest.mark.parametrize("unordered", [False, True])
def test_landing_by_pickup_day(spark, tmp_path, unordered):
    rows = [{"tpep_pickup_datetime": datetime(2025, 3, 1 + i % 3, 23, 30)} for i in range(30)]
    write_files(spark, tmp_path / "in", [[*rows, {"tpep_pickup_datetime": None}]])
    session = zoned_session(spark, "UTC")
    source = replay_trips(session, str(tmp_path / "in"))
    out = tmp_path / "out"
    land_partitioned(source, str(out), str(tmp_path / "cp"), None, 4, unordered).awaitTermination()
    day = out / "year=2025" / "month=03" / "day=02"
    assert len(list(day.glob("*.parquet"))) >= 3
    assert read_landed_trips(spark, str(out), 2025, 3).count() == 30
    assert read_landed_trips(spark, str(out)).count() == 31


def test_landing_text_and_console(spark, tmp_path):
    write_files(spark, tmp_path / "in", [[{}, {"VendorID": 2}]])
    source = replay_trips(spark, str(tmp_path / "in")).select(
        F.concat_ws(",", "VendorID", "total_amount").cast("binary").alias("value")
    )
    land_text(source, str(tmp_path / "out"), str(tmp_path / "cp"), None).awaitTermination()
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "out")).collect()) == ["1,20.0", "2,20.0"]
    printed = console_stream(source.select(F.col("value").cast("string")))
    printed.awaitTermination()
    assert printed.lastProgress["numInputRows"] == 2


def test_header(spark):
    row = spark.range(1).select(add_header(F.lit(b"abc"), 258).alias("v")).select("v", strip_header(F.col("v")))
    assert [bytes(v) for v in row.head()] == [b"\x00\x00\x00\x01\x02abc", b"abc"]


def test_key_and_millis(spark):
    no_vendor, no_pickup = {"VendorID": None}, {"tpep_pickup_datetime": None}
    rows = trips(spark, {}, no_vendor, no_pickup, no_vendor | no_pickup)
    assert [r[0] for r in rows.select(trip_key()).collect()] == ["1:2025-03-01", "2025-03-01", "1", ""]
    name, utc = "tpep_pickup_datetime", 1751328001234
    stamp = {name: datetime(2025, 7, 1, 0, 0, 1, 234567)}
    for zone, hours in (("UTC", 0), ("America/New_York", 4), ("Asia/Tokyo", -9)):
        there = zoned_session(spark, zone)
        assert trips(there, stamp).select(epoch_millis(name)).head()[0] == utc + hours * 3600 * 1000
    early = trips(spark, {name: datetime(1969, 12, 31, 23, 59, 59, 500000)})
    assert early.select(epoch_millis(name)).head()[0] == -500


def encode(record, schema):
    return F.to_json(record).cast("binary")


def decode(record, schema, options):
    return F.from_json(record.cast("string"), TRIP_V2, options)


def test_published_trips_decode_to_themselves(spark, tmp_path):
    batch = trips(spark, {}, {"VendorID": 2, "extra": None}, {"tpep_dropoff_datetime": None})
    publish = publish_batches("", "", 3, partitions=2, source="parquet", encode=encode, path=str(tmp_path / "t"))
    publish(batch.limit(0), 0)
    assert not (tmp_path / "t").exists()
    publish(batch, 1)
    messages = spark.read.parquet(str(tmp_path / "t"))
    assert messages.columns == ["key", "value"]
    decoded = decode_envelope(messages, "", decode=decode)
    as_read = batch.withColumns({f.name: F.col(f.name).cast(f.dataType) for f in TRIP_V2})
    assert same_rows(decoded, as_read)


def test_old_message_version_and_back(spark):
    rows = trips(spark, {}, {"passenger_count": None})
    old = old_message_fields(rows)
    assert old.schema == TRIP_V1
    assert old.head().tpep_pickup_datetime == "2025-03-01 10:00:00"
    assert same_rows(conform_trips(old), conform_trips(rows.select(*[F.col(f.name).cast(f.dataType) for f in TRIP_V2])))


def test_broken_message_by_mode(spark):
    broken = spark.createDataFrame([(bytearray(b"\x00\x00\x00\x00\x01{oops"),)], "value binary")
    assert decode_envelope(broken, "", "PERMISSIVE", decode).head().VendorID is None
    with pytest.raises(Exception, match="MALFORMED"):
        decode_envelope(broken, "", "FAILFAST", decode).collect()


def test_enrichment_of_a_table(spark):
    out = enrich_with_zones(trips(spark, {}, {"PULocationID": 4}), zones(spark, [10, 11]))
    assert [r.zone for r in out.collect()] == ["Z10"]


def test_scratch_path_is_shared_and_fresh(spark):
    one, two = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert one != two
    assert one.startswith(spark.conf.get("spark.checkpoint.dir"))


def test_text_event_time(spark):
    rows = spark.createDataFrame([("2025-03-01 10:07:00",)], "tpep_pickup_datetime string")
    row = window_counts(with_event_time(rows)).head()
    assert (row.window_start, row.window_end) == ("2025-03-01 10:00:00", "2025-03-01 10:10:00")


def test_good_row_matches_the_schema(spark):
    assert list(GOOD) == TRIP_V2.names == wall_clock(TRIP_V2).names


def test_replay_in_update_mode_counts_every_row(spark, tmp_path):
    write_files(spark, tmp_path / "in", LATE)
    source = replay_trips(spark, str(tmp_path / "in"), latest_first=False)
    target = str(tmp_path / "counts")
    write = upsert_batches(target, WINDOW_KEYS)
    start_window_counts(source, str(tmp_path / "cp"), write, "update", watermark=None).awaitTermination()
    assert sum(r.trip_count for r in read_upserted(spark, target).collect()) == sum(map(len, LATE))


def test_a_hot_day_lands_in_a_bounded_number_of_files(spark, tmp_path):
    rows = [at(i % 60) | {"total_amount": float(i + 1)} for i in range(400)]
    write_files(spark, tmp_path / "in", [rows])
    source = replay_trips(zoned_session(spark, "UTC"), str(tmp_path / "in"))
    out = tmp_path / "out"
    land_partitioned(source, str(out), str(tmp_path / "cp"), None, unordered=True, files_per_day=3).awaitTermination()
    files = list((out / "year=2025" / "month=03" / "day=01").glob("*.parquet"))
    assert 1 <= len(files) <= 3
    assert read_landed_trips(spark, str(out)).count() == 400


@pytest.mark.parametrize("version", [1, 2])
def test_replayed_files_conform_first(spark, tmp_path, version):
    seen = {}
    rows = conform_trips(trips(spark, {}).withColumn("VendorID", F.lit(1).cast("bigint")))

    def encode(record, schema):
        seen["schema"] = schema
        return F.to_json(record).cast("binary")

    publish = publish_batches("", "", 7, source="parquet", encode=encode, version=version, schema="{}", path=str(tmp_path / "t"))
    publish(rows, 0)
    value = bytes(spark.read.parquet(str(tmp_path / "t")).head().value)
    assert seen["schema"] == "{}" and value[:5] == bytes([0, 0, 0, 0, 7])
    assert (b'"tpep_pickup_datetime":"2025-03-01 10:00:00"' in value) == (version == 1)


def landed_files(out):
    return {str(p.parent.relative_to(out)): len(list(p.parent.glob("*.parquet"))) for p in out.rglob("*.parquet")}


def test_even_days_land_in_one_file_a_trigger(spark, tmp_path):
    rows = [{"tpep_pickup_datetime": datetime(2025, 3, 1 + i % 25, i % 24)} for i in range(500)]
    write_files(spark, tmp_path / "in", [rows[:250], rows[250:]])
    out, session = tmp_path / "out", zoned_session(spark, "UTC")
    source = replay_trips(session, str(tmp_path / "in"))
    land_partitioned(source, str(out), str(tmp_path / "cp"), None, unordered=True).awaitTermination()
    assert set(landed_files(out).values()) == {2} and len(landed_files(out)) == 25
    assert read_landed_trips(spark, str(out)).count() == 500


def test_a_hot_day_is_split_over_tasks(spark, tmp_path):
    hot = spark.range(60_000).selectExpr(
        "timestamp_ntz '2025-03-01 12:00:00' AS tpep_pickup_datetime", "id AS n", "uuid() AS filler"
    )
    even = spark.range(2_000).selectExpr(
        "timestampadd(DAY, cast(id % 20 AS int) + 1, timestamp_ntz '2025-03-01 12:00:00') AS tpep_pickup_datetime",
        "id AS n",
        "uuid() AS filler",
    )
    rows = hot.unionAll(even)
    rows.write.parquet(str(tmp_path / "in"))
    session = zoned_session(spark, "UTC")
    session.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    source = replay_trips(session, str(tmp_path / "in"), max_files=1000)
    out = tmp_path / "out"
    land_partitioned(source, str(out), str(tmp_path / "cp"), None, unordered=True).awaitTermination()
    files = landed_files(out)
    assert files.pop("year=2025/month=03/day=01") >= 3
    assert set(files.values()) == {1}
    assert read_landed_trips(spark, str(out)).agg(F.countDistinct("n", "filler")).head()[0] == 62_000


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    rows = [{"tpep_pickup_datetime": datetime(2025, 3, 1 + i % 5, 8), "total_amount": float(i + 1)} for i in range(50)]
    write_files(spark, tmp_path / "in", [rows[:20], rows[20:]])
    out, checkpoint = tmp_path / "out", tmp_path / "cp"

    def land():
        source = replay_trips(zoned_session(spark, "UTC"), str(tmp_path / "in"), latest_first=False)
        land_partitioned(source, str(out), str(checkpoint), None, unordered=True).awaitTermination()

    land()
    # As after a crash between the last batch's files and its commit, with a file of it missing.
    (checkpoint / "commits" / "1").unlink()
    (checkpoint / "commits" / ".1.crc").unlink()
    lost = next(iter(out.rglob("*-000000001-*.parquet")))
    lost.unlink()
    land()
    assert sorted(r.total_amount for r in read_landed_trips(spark, str(out)).collect()) == [i + 1.0 for i in range(50)]
    # Another stream into the same folder adds its rows.
    source = replay_trips(zoned_session(spark, "UTC"), str(tmp_path / "in"), latest_first=False)
    land_partitioned(source, str(out), str(tmp_path / "cp2"), None, unordered=True).awaitTermination()
    assert read_landed_trips(spark, str(out)).count() == 100


def test_a_folder_of_the_file_sink_is_refused(spark, tmp_path):
    write_files(spark, tmp_path / "in", [[at(0)]])
    append_stream(replay_trips(spark, str(tmp_path / "in")), str(tmp_path / "cp1"), str(tmp_path / "out")).awaitTermination()
    source = replay_trips(spark, str(tmp_path / "in"))
    query = land_partitioned(source, str(tmp_path / "out"), str(tmp_path / "cp2"), None)
    with pytest.raises(Exception, match="choose another folder"):
        query.awaitTermination()
