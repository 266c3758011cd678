from datetime import datetime

import pytest
from rows import facts, plan_of, same_rows, trips, zones

from farelake.plans import batch
from farelake.schemas import SORT_KEYS, TABLES, TRIP_V1, TRIP_V2, ContractError, avro_schema
from farelake.sinks import jdbc as jdbc_sink
from farelake.sinks.tables import read_star_or_mart, run_summary, table_path, write_parquet, write_star_or_mart
from farelake.sinks.upsert import KEEP_VERSIONS, document_options, read_upserted, upsert
from farelake.sources import files, jdbc, kafka


@pytest.fixture(scope="module")
def raw(spark):
    return trips(
        spark,
        *[
            {
                "tpep_pickup_datetime": datetime(2025, 1 + i % 3, 1 + i % 20, i % 23),
                "tpep_dropoff_datetime": datetime(2025, 1 + i % 3, 1 + i % 20, i % 23, 30),
                "PULocationID": 1 + i % 300,
                "payment_type": i % 9,
            }
            for i in range(300)
        ],
    )


def test_every_table_has_a_sort_key_of_its_own_columns():
    assert set(SORT_KEYS) == set(TABLES)
    assert all(set(SORT_KEYS[n]) <= set(TABLES[n].names) for n in TABLES)


@pytest.mark.parametrize("options", [{}, {"by_month": True, "calendar": "join"}])
def test_second_run_gives_the_same_tables(spark, raw, tmp_path, options):
    root = str(tmp_path / "dw")
    first = batch.run_batch_on(spark, raw, zones(spark, range(1, 200)), root, **options)
    counts = {r.table_name: r.row_count for r in first.summary.collect()}
    # 37 pickup zones are out of range, 33 payment types are 0 and stay as unknown.
    assert counts["fact_trip"] == 263
    assert counts["agg_revenue_breakdown"] == 3
    assert set(counts) == set(TABLES)
    before = {n: read_star_or_mart(spark, root, n).collect() for n in TABLES}
    second = batch.run_batch_on(spark, raw, zones(spark, range(1, 200)), root, **options)
    assert {r.table_name: r.row_count for r in second.summary.collect()} == counts
    for name, rows in before.items():
        assert sorted(map(str, rows)) == sorted(map(str, read_star_or_mart(spark, root, name).collect())), name


def test_layouts_hold_the_same_fact(spark, raw, tmp_path):
    for name, options in {"flat": {}, "months": {"by_month": True}, "join": {"calendar": "join"}}.items():
        batch.build_star(spark, raw, zones(spark, [1, 20]), str(tmp_path / name), **options)
    flat, months, join = (
        read_star_or_mart(spark, str(tmp_path / n), "fact_trip").drop("fact_trip_sk")
        for n in ("flat", "months", "join")
    )
    assert same_rows(flat, months) and same_rows(flat, join)
    assert (tmp_path / "months" / "fact_trip" / "pickup_month=2025-02").is_dir()
    times = [read_star_or_mart(spark, str(tmp_path / n), "dim_time") for n in ("flat", "join")]
    assert same_rows(*times)


def test_unknown_calendar_is_refused(spark, raw, tmp_path):
    with pytest.raises(ValueError, match="calendar"):
        batch.build_star(spark, raw, zones(spark, [1]), str(tmp_path), calendar="guess")


def test_run_from_files(spark, raw, tmp_path):
    raw.repartition(3).write.parquet(str(tmp_path / "trips"))
    (tmp_path / "zones.csv").write_text(
        'LocationID,Borough,Zone,service_zone\n1,EWR,"Newark, Airport",EWR\n20,Bronx,Belmont,Boro\n'
    )
    run = batch.run_batch(spark, str(tmp_path / "trips"), str(tmp_path / "zones.csv"), str(tmp_path / "dw"))
    counts = {r.table_name: r.row_count for r in run.summary.collect()}
    assert (counts["fact_trip"], counts["dim_location"]) == (263, 2)
    zone = read_star_or_mart(spark, run.root, "dim_location").filter("location_id = 1").head()
    assert zone.zone == "Newark, Airport"


def test_overwrite_of_partitions_leaves_the_others(spark, tmp_path):
    path = str(tmp_path / "t")
    write_parquet(spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string"), path, ["v"], ["p"])
    later = spark.createDataFrame([(3, "b")], "v int, p string")
    write_parquet(later, path, ["v"], ["p"], replace="partitions")
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [(1, "a"), (3, "b")]
    write_parquet(later, path, ["v"], ["p"])
    assert [tuple(r) for r in spark.read.parquet(path).collect()] == [(3, "b")]


def test_table_append_and_contract(spark, tmp_path):
    root = str(tmp_path)
    write_star_or_mart(facts(spark, {}), root, "fact_trip")
    write_star_or_mart(facts(spark, {}), root, "fact_trip", mode="append")
    assert run_summary(spark, root, ["fact_trip"]).head().row_count == 2
    with pytest.raises(ContractError, match="fact_trip"):
        write_star_or_mart(facts(spark, {}).drop("extra"), root, "fact_trip")
    assert table_path("/a/", "b") == "/a/b"


def test_files_are_sorted_by_the_table_key(spark, tmp_path):
    rows = facts(spark, *[{"pickup_time_sk": datetime(2025, 3, 1, h)} for h in (5, 3, 9, 1)]).coalesce(1)
    write_star_or_mart(rows, str(tmp_path), "fact_trip")
    stored = read_star_or_mart(spark, str(tmp_path), "fact_trip").collect()
    assert [r.pickup_time_sk.hour for r in stored] == [1, 3, 5, 9]


def test_upsert_replaces_and_adds(spark, tmp_path):
    target = str(tmp_path / "u")
    schema = "k timestamp, label string, n long"
    t1, t2 = datetime(2025, 1, 1), datetime(2025, 1, 2)
    assert read_upserted(spark, target) is None
    upsert(spark.createDataFrame([(t1, "a", 1)], schema), target, ["k"])
    batch2 = spark.createDataFrame([(t1, "a", 5), (t2, "b", 1)], schema)
    for _ in range(KEEP_VERSIONS + 2):
        upsert(batch2, target, ["k"])
        got = sorted((r.label, r.n) for r in read_upserted(spark, target).collect())
        assert got == [("a", 5), ("b", 1)]
    upsert(spark.createDataFrame([(t2, "b", 9)], schema), target, ["k"])
    assert sorted((r.label, r.n) for r in read_upserted(spark, target).collect()) == [("a", 5), ("b", 9)]
    assert len([p for p in (tmp_path / "u").iterdir() if p.name.startswith("version-")]) == KEEP_VERSIONS


def test_unfinished_version_is_ignored_and_replaced(spark, tmp_path):
    target = tmp_path / "u"
    upsert(spark.createDataFrame([(1, 1)], "k int, n int"), str(target), ["k"])
    broken = target / "version-000000000001"
    broken.mkdir()
    (broken / "part-0.parquet").write_text("half")
    assert read_upserted(spark, str(target)).count() == 1
    upsert(spark.createDataFrame([(2, 2)], "k int, n int"), str(target), ["k"])
    assert read_upserted(spark, str(target)).count() == 2


def test_document_options():
    assert "idFieldList" not in document_options("mongodb://h", "d", "c")
    keyed = document_options("mongodb://h", "d", "c", ["a", "b"])
    assert (keyed["idFieldList"], keyed["operationType"]) == ("a,b", "update")


def test_jdbc_options():
    split = jdbc.table_options("u", "t", {"user": "x"}, "location_id", 1, 265, 8)
    assert split["numPartitions"] == "8" and split["lowerBound"] == "1" and split["user"] == "x"
    assert "partitionColumn" not in jdbc.table_options("u", "t", {})
    with pytest.raises(ValueError, match="together"):
        jdbc.table_options("u", "t", {}, column="location_id")
    assert jdbc_sink.create_clause(["a"]) == "ENGINE = MergeTree ORDER BY a"
    assert jdbc_sink.create_clause(["a", "b"]) == "ENGINE = MergeTree ORDER BY (a, b)"
    assert jdbc_sink.writer_options("jdbc:postgresql:x", "t", {}, ["a"], "overwrite")["truncate"] == "true"
    with pytest.raises(ValueError, match="append"):
        jdbc_sink.writer_options("jdbc:clickhouse:x", "t", {}, ["a"], "overwrite")
    assert "truncate" not in jdbc_sink.writer_options("u", "t", {}, ["a"])
    assert "createTableOptions" not in jdbc_sink.writer_options("u", "t", {}, ["a"], engine=None)


def test_preflight(spark):
    jdbc.require_database(spark, "default")
    with pytest.raises(LookupError, match="nowhere"):
        jdbc.require_database(spark, "nowhere")
    with pytest.raises(LookupError, match="cannot query"):
        jdbc.require_jdbc(spark, "jdbc:unknown:x", {})


def test_kafka_options():
    assert kafka.kafka_options("s", "t")["startingOffsets"] == "latest"
    assert kafka.kafka_options("s", "t", "earliest", 5)["maxOffsetsPerTrigger"] == "5"


def test_replay_takes_one_limit(spark, raw, tmp_path):
    path = str(tmp_path / "t")
    raw.write.parquet(path)
    assert files.schema_of(spark, path).names == TRIP_V2.names
    for wrong in ({"max_files": None}, {"max_bytes": 10}, {"max_files": 0}, {"max_files": None, "max_bytes": "16m"}):
        with pytest.raises(ValueError):
            files.replay_trips(spark, path, **wrong)
    assert files.replay_trips(spark, path).isStreaming
    assert files.replay_trips(spark, path, max_files=None, max_bytes=1 << 24).isStreaming


def test_landed_folders_are_pruned(spark, raw, tmp_path):
    path = str(tmp_path / "l")
    days = raw.selectExpr(
        "*", "year(tpep_pickup_datetime) year", "month(tpep_pickup_datetime) month", "day(tpep_pickup_datetime) day"
    )
    days.write.partitionBy("year", "month", "day").parquet(path)
    march = files.read_landed_trips(spark, path, 2025, 3)
    assert march.count() == 100
    assert march.columns == TRIP_V2.names
    assert "PartitionFilters: [isnotnull(year" in plan_of(march)


def test_avro_schema_text():
    import json

    v2 = {f["name"]: f["type"][1] for f in json.loads(avro_schema(TRIP_V2))["fields"]}
    v1 = {f["name"]: f["type"][1] for f in json.loads(avro_schema(TRIP_V1))["fields"]}
    assert v2["tpep_pickup_datetime"] == {"type": "long", "logicalType": "timestamp-millis"}
    assert (v2["VendorID"], v2["passenger_count"], v2["Airport_fee"]) == ("int", "long", "double")
    assert (v1["tpep_pickup_datetime"], v1["passenger_count"], v1["airport_fee"]) == ("string", "int", "float")
    assert len(v1) == len(v2) == 20


def test_failed_write_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    write_parquet(spark.createDataFrame([(1,)], "v int"), path)
    broken = spark.range(100, numPartitions=4).selectExpr("assert_true(id < 90) AS ok", "id AS v")
    with pytest.raises(Exception, match="true"):
        write_parquet(broken, path)
    assert [r.v for r in spark.read.parquet(path).collect()] == [1]
    write_parquet(spark.createDataFrame([(2,)], "v int"), path)
    assert [r.v for r in spark.read.parquet(path).collect()] == [2]
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_upsert_settles_equal_keys_from_the_first_version(spark, tmp_path):
    twice = spark.createDataFrame([(1, 5), (1, 7), (2, 1)], "k int, n int")
    for target, whole in (("a", False), ("b", True)):
        for _ in range(2):
            upsert(twice, str(tmp_path / target), ["k"], whole)
            assert sorted(map(tuple, read_upserted(spark, str(tmp_path / target)).collect())) == [(1, 7), (2, 1)]
    upsert(twice.where("k = 2"), str(tmp_path / "b"), ["k"], whole=True)
    assert read_upserted(spark, str(tmp_path / "b")).count() == 1


def test_repeated_lookup_key_is_refused(spark, tmp_path):
    two = zones(spark, [1]).unionAll(zones(spark, [1]))
    with pytest.raises(ValueError, match="occurs 2 times"):
        batch.build_star(spark, trips(spark, {}), two, str(tmp_path))


def test_time_ranges_split_the_fact_evenly(spark, tmp_path, monkeypatch):
    rows = facts(spark, *[{"created_at_sk": datetime(2025, 3, 1 + i % 28, i % 24)} for i in range(2000)])
    rows.createOrReplaceTempView("fact_trip")
    spark.table("fact_trip").selectExpr("created_at_sk AS timestamp_id").createOrReplaceTempView("dim_time")
    span = spark.sql("SELECT cast(min(created_at_sk) AS string), cast(max(created_at_sk) AS string) FROM fact_trip").head()
    low, high = (datetime.fromisoformat(v) for v in span)
    counts = [0] * 8
    for (at,) in rows.select("created_at_sk").collect():
        counts[min(7, int(8 * (at - low) / (high - low)))] += 1
    assert max(counts) < 2 * min(counts)
