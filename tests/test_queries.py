import pytest
from compare import differences, duck

import __spark_entry__ as registry
from farelake.plans.checks import QUERIES


@pytest.fixture(scope="module")
def con(small):
    return duck(small)


def test_every_query_has_its_sql():
    assert set(QUERIES) <= set(registry.oracle_sql()) <= set(registry.queries())


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_sql(spark, small, con, name):
    assert differences(registry.queries()[name](spark, small), registry.oracle_sql()[name], con) == []


def test_entry(spark):
    assert registry.entry(spark).head() is not None


def test_session_zone_does_not_change_results(spark, small, con):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        for name in ("fact_trip", "mart_daily_trips", "mart_hourly_patterns", "message_keys", "event_window_counts"):
            assert differences(registry.queries()[name](spark, small), registry.oracle_sql()[name], con) == [], name
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
