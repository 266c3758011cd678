import pytest
from rows import same_rows, trips, zones

import farelake.__main__ as jobs
from farelake.plans import batch
from farelake.schemas import MART_TABLES, SORT_KEYS, STAR_TABLES
from farelake.sinks.tables import read_star_or_mart


def test_batch_job(spark, tmp_path, capsys):
    trips(spark, {}, {"VendorID": 2}).write.parquet(str(tmp_path / "trips"))
    (tmp_path / "z.csv").write_text("LocationID,Borough,Zone,service_zone\n10,B,Z,S\n")
    jobs.main(
        ["--time-zone", "UTC", "batch", "--by-month"]
        + ["--trips", str(tmp_path / "trips"), "--zones", str(tmp_path / "z.csv"), "--root", str(tmp_path / "dw")]
    )
    assert "agg_popular_routes" in capsys.readouterr().out
    assert read_star_or_mart(spark, str(tmp_path / "dw"), "fact_trip").count() == 2


def test_time_zone_is_required():
    with pytest.raises(SystemExit):
        jobs.main(["batch", "--trips", "a", "--zones", "b", "--root", "c"])


def test_export_replaces_every_table(spark, tmp_path, monkeypatch):
    batch.run_batch_on(spark, trips(spark, {}), zones(spark, [10]), str(tmp_path))
    written = {}
    monkeypatch.setattr(batch, "require_jdbc", lambda *a: None)
    monkeypatch.setattr(
        batch, "write_table", lambda df, url, table, props, key, mode, *a: written.update({table: (key, mode)})
    )
    batch.export_tables(spark, str(tmp_path), "jdbc:x", {}, "dw.")
    assert written == {f"dw.{n}": (SORT_KEYS[n], "overwrite") for n in (*STAR_TABLES, *MART_TABLES)}


def test_marts_from_a_database(spark, tmp_path, monkeypatch):
    batch.run_batch_on(spark, trips(spark, {}, {}), zones(spark, [10]), str(tmp_path / "a"))
    calls = []

    def read(spark, url, table, props, *split):
        calls.append((table, split))
        return read_star_or_mart(spark, str(tmp_path / "a"), table)

    monkeypatch.setattr(batch, "read_table", read)
    monkeypatch.setattr(batch, "read_span", lambda spark, url, table, props, column: ("2025-03-01", "2025-03-02"))
    tables = batch.database_star(spark, "jdbc:x", {}, partitions=4)
    assert ("fact_trip", ("created_at_sk", "2025-03-01", "2025-03-02", 4)) in calls
    assert ("dim_time", ("timestamp_id", "2025-03-01", "2025-03-02", 4)) in calls
    batch.build_marts(spark, str(tmp_path / "b"), tables=tables)
    for name in MART_TABLES:
        assert same_rows(*(read_star_or_mart(spark, str(tmp_path / d), name) for d in "ab")), name
