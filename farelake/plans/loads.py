"""Marts kept up to date: each load adds its trips, and nothing of earlier loads is read again but their states.

A load stores its fact rows, its times and its two roll-ups in folders of its own. The roll-ups are additive states, so
the marts follow from all loads' states together. A load that runs again replaces its folders.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from farelake.operators import marts, star
from farelake.operators.clean import clean_trips, conform_trips
from farelake.plans.batch import ROLLUPS, marts_of_rollups, store_lookups
from farelake.schemas import MART_TABLES, SORT_KEYS, STAR_TABLES, TABLES, assert_contract
from farelake.session import delete_path, in_parallel
from farelake.sinks.tables import read_star_or_mart, table_path, write_parquet

LOADED = ("fact_trip", "dim_time")


def _folder(root: str, table: str, load: str) -> str:
    return f"{table_path(root, table)}/load={load}"


def read_loaded(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table of the star or a mart over all loads. Loads may share moments, so times are made distinct."""
    if name not in LOADED:
        return read_star_or_mart(spark, root, name)
    table = spark.read.parquet(table_path(root, name)).select(*TABLES[name].names)
    return table.dropDuplicates(["timestamp_id"]) if name == "dim_time" else table


def load_trips(
    spark: SparkSession,
    trips: DataFrame,
    locations: DataFrame,
    root: str,
    load: str,
    names: Sequence[str] = tuple(MART_TABLES),
) -> dict[str, int]:
    """Cleanse the trips of one load, store them beside those of other loads and bring the marts up to date, all eight
    unless named; returns the rows of each table, of the load's own part for the fact and the times.

    ``load`` names the load, such as its month; running it again replaces what it stored. A trip belongs to the load
    that brings it, whenever it took place, so late trips of earlier days need no other treatment. The raw trips are read
    once, the load's fact rows twice more, and of other loads only the states: at most the calendar by vendors and
    payment types, and pairs of zones, for each load. ``fact_trip_sk`` is unique within a load.
    """
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", load):
        raise ValueError(f"not the name of a load: {load!r}")
    lookups = {
        "dim_vendor": star.dim_vendor(spark),
        "dim_ratecode": star.dim_ratecode(spark),
        "dim_payment": star.dim_payment(spark),
        "dim_location": locations,
    }
    rows, lookups = store_lookups(spark, lookups, root)
    fact = star.fact_trip(clean_trips(conform_trips(trips)), *lookups.values())
    assert_contract(fact, STAR_TABLES["fact_trip"], "fact_trip")
    rows["fact_trip"] = write_parquet(fact, _folder(root, "fact_trip", load), SORT_KEYS["fact_trip"])
    fact = spark.read.parquet(_folder(root, "fact_trip", load))
    parts = {
        "dim_time": star.dim_time(fact, "pickup_time_sk", "dropoff_time_sk"),
        "rollup_time": marts.time_rollup(fact),
        "rollup_route": marts.route_rollup(fact),
    }
    order = {"dim_time": SORT_KEYS["dim_time"]}
    counts = in_parallel(
        [partial(write_parquet, part, _folder(root, name, load), order.get(name, ())) for name, part in parts.items()]
    )
    rows["dim_time"] = counts[0]
    return rows | (marts_of_rollups(spark, root, lookups, names) if names else {})


def drop_load(spark: SparkSession, root: str, load: str) -> dict[str, int]:
    """Take a load's trips out of the star and the marts again. At least one load must stay."""
    for name in (*LOADED, *ROLLUPS):
        delete_path(spark, _folder(root, name, load))
    lookups = {name: read_star_or_mart(spark, root, name) for name in ("dim_vendor", "dim_payment", "dim_location")}
    return marts_of_rollups(spark, root, lookups, tuple(MART_TABLES))
