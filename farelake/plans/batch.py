"""Batch layer: raw trips -> star schema -> marts, all stored, all repeatable."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.operators import marts, star
from farelake.operators.clean import clean_trips, conform_trips
from farelake.operators.keys import with_dense_key
from farelake.schemas import MART_TABLES, SORT_KEYS, STAR_TABLES
from farelake.session import in_parallel
from farelake.sinks.jdbc import write_table
from farelake.sinks.tables import read_star_or_mart, summary_of, table_path, write_parquet, write_star_or_mart
from farelake.sources.files import read_trips, read_zones
from farelake.sources.jdbc import read_parts, read_sample, read_span, read_table, require_jdbc, split_predicates

FACT_FOLDER = "pickup_month"
ROLLUPS = ("rollup_time", "rollup_route")
# The tables that grow with the trips, and the time that splits them evenly.
TIME_COLUMNS = {"fact_trip": "created_at_sk", "dim_time": "timestamp_id"}
# Whole-number keys that a sample is drawn by, one row of so many; moments of the time dimension occur once.
KEY_COLUMNS, SAMPLED = {"fact_trip": "fact_trip_sk"}, 100


@dataclass(frozen=True)
class BatchRun:
    """Where a run stored its tables, and the rows of each."""

    root: str
    summary: DataFrame


def build_star(
    spark: SparkSession,
    trips: DataFrame,
    locations: DataFrame,
    root: str,
    calendar: str = "derive",
    by_month: bool = False,
    clustered: bool = False,
    dense_keys: bool = False,
) -> dict[str, int]:
    """Cleanse the trips and store the five dimensions and the fact; returns the rows of each.

    The raw trips are read once and the fact is written without a shuffle: the time dimension comes
    from the two timestamp columns of the stored fact. ``by_month`` brings the fact's rows together in
    a folder per pickup month, at the price of a shuffle. With ``calendar="join"`` the time dimension
    is stored first and the fact joined to it. ``clustered`` deals the fact to files by ranges of its sort key, and
    ``dense_keys`` counts its surrogate key from 0 in the order of the rows, whatever the partitioning: a shuffle each.
    """
    if calendar not in ("derive", "join"):
        raise ValueError(f"calendar is 'derive' or 'join', not {calendar!r}")
    clean = clean_trips(conform_trips(trips))
    lookups = {
        "dim_vendor": star.dim_vendor(spark),
        "dim_ratecode": star.dim_ratecode(spark),
        "dim_payment": star.dim_payment(spark),
        "dim_location": locations,
    }
    rows, lookups = store_lookups(spark, lookups, root)

    times = None
    if calendar == "join":
        rows["dim_time"] = write_star_or_mart(star.dim_time(clean), root, "dim_time")
        times = read_star_or_mart(spark, root, "dim_time")
    fact = star.fact_trip(clean, *lookups.values(), times=times)
    if dense_keys:
        fact = with_dense_key(fact, "fact_trip_sk", SORT_KEYS["fact_trip"])
    folders = [FACT_FOLDER] if by_month else []
    if by_month:
        fact = fact.withColumn(FACT_FOLDER, F.date_format("pickup_time_sk", "yyyy-MM"))
    rows["fact_trip"] = write_star_or_mart(fact, root, "fact_trip", folders, clustered=clustered)
    if calendar == "derive":
        stored = read_star_or_mart(spark, root, "fact_trip")
        times = star.dim_time(stored, "pickup_time_sk", "dropoff_time_sk")
        rows["dim_time"] = write_star_or_mart(times, root, "dim_time")
    return rows


def store_lookups(
    spark: SparkSession, lookups: dict[str, DataFrame], root: str
) -> tuple[dict[str, int], dict[str, DataFrame]]:
    """Stores the lookup tables side by side and refuses one whose key repeats; their rows, and the stored tables."""

    def store(name: str) -> int:
        rows = write_star_or_mart(lookups[name].hint("rebalance"), root, name)
        require_unique(read_star_or_mart(spark, root, name), name)
        return rows

    counts = in_parallel([partial(store, name) for name in lookups])
    return dict(zip(lookups, counts, strict=True)), {name: read_star_or_mart(spark, root, name) for name in lookups}


def stored_star(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The stored dimensions and the fact."""
    return {name: read_star_or_mart(spark, root, name) for name in STAR_TABLES}


def database_star(
    spark: SparkSession,
    url: str,
    properties: dict[str, str],
    prefix: str = "",
    partitions: int = 1,
    split: str = "ranges",
) -> dict[str, DataFrame]:
    """The dimensions and the fact from a database.

    With more than one partition the fact and the time dimension, which grow with the trips, are read in that
    many ranges of time between the first and the last one stored: equal ranges, or with ``split="quantiles"`` ranges
    that hold about equally many rows, after one more query for every hundredth row's time.
    """
    if split not in ("ranges", "quantiles"):
        raise ValueError(f"split is 'ranges' or 'quantiles', not {split!r}")
    star_tables = {name: read_table(spark, url, prefix + name, properties) for name in STAR_TABLES}
    for name, column in TIME_COLUMNS.items() if partitions > 1 else ():
        if split == "quantiles":
            tie = KEY_COLUMNS.get(name)
            sample = read_sample(spark, url, prefix + name, properties, column, tie, SAMPLED if tie else 1)
            predicates = split_predicates(sample, column, partitions, tie)
            star_tables[name] = read_parts(spark, url, prefix + name, properties, predicates)
            continue
        span = read_span(spark, url, prefix + name, properties, column)
        if span is not None:
            ranges = (column, *span, partitions)
            star_tables[name] = read_table(spark, url, prefix + name, properties, *ranges)
    return star_tables


def require_unique(table: DataFrame, name: str) -> None:
    """Refuse a lookup whose key repeats: it would multiply trips where names are joined to them."""
    key = SORT_KEYS[name][0]
    twice = table.groupBy(key).count().where("count > 1").head()
    if twice is not None:
        raise ValueError(f"{name}: {key} {twice[0]!r} occurs {twice[1]} times")


def build_marts(
    spark: SparkSession,
    root: str,
    calendar: str = "derive",
    tables: dict[str, DataFrame] | None = None,
    names: Sequence[str] = tuple(MART_TABLES),
) -> dict[str, int]:
    """Store the two roll-ups of the fact, then the marts derived from them, all eight unless named; their rows.

    Marts are small next to the cluster, so they are written side by side. ``tables`` is the star schema to read, by default the one stored under ``root``.
    """
    tables = tables or stored_star(spark, root)
    fact = tables["fact_trip"]
    times = tables["dim_time"] if calendar == "join" else None
    rollups = {"rollup_time": marts.time_rollup(fact, times), "rollup_route": marts.route_rollup(fact)}
    in_parallel([partial(write_parquet, rollup, table_path(root, name)) for name, rollup in rollups.items()])
    return marts_of_rollups(spark, root, tables, names)


def marts_of_rollups(
    spark: SparkSession, root: str, tables: dict[str, DataFrame], names: Sequence[str] = tuple(MART_TABLES)
) -> dict[str, int]:
    """The marts of the stored roll-ups, which may hold several states of a key."""
    stored = [spark.read.parquet(table_path(root, name)) for name in ROLLUPS]
    lookups = [tables[name] for name in ("dim_vendor", "dim_payment", "dim_location")]
    found = marts.all_marts(*stored, *lookups)
    rows = in_parallel([partial(write_star_or_mart, found[name], root, name) for name in names])
    return dict(zip(names, rows, strict=True))


def run_batch_on(
    spark: SparkSession,
    trips: DataFrame,
    locations: DataFrame,
    root: str,
    calendar: str = "derive",
    by_month: bool = False,
    clustered: bool = False,
    dense_keys: bool = False,
) -> BatchRun:
    """Star schema, then marts; every table is replaced, so running twice changes nothing."""
    rows = build_star(spark, trips, locations, root, calendar, by_month, clustered, dense_keys)
    rows |= build_marts(spark, root, calendar)
    return BatchRun(root, summary_of(spark, rows))


def run_batch(
    spark: SparkSession,
    trips_path: str,
    zones_path: str,
    root: str,
    calendar: str = "derive",
    by_month: bool = False,
    mixed: bool = False,
    clustered: bool = False,
    dense_keys: bool = False,
) -> BatchRun:
    """The whole batch layer from trip files, of mixed physical types if so told, and the zone CSV."""
    trips = read_trips(spark, trips_path, mixed)
    zones = read_zones(spark, zones_path)
    return run_batch_on(spark, trips, zones, root, calendar, by_month, clustered, dense_keys)


def run_marts_from_database(
    spark: SparkSession,
    url: str,
    properties: dict[str, str],
    root: str,
    prefix: str = "",
    partitions: int = 8,
    split: str = "ranges",
) -> BatchRun:
    """The marts from a star schema that a database holds."""
    require_jdbc(spark, url, properties)
    rows = build_marts(spark, root, tables=database_star(spark, url, properties, prefix, partitions, split))
    return BatchRun(root, summary_of(spark, rows))


def export_tables(
    spark: SparkSession,
    root: str,
    url: str,
    properties: dict[str, str],
    prefix: str = "",
    names: Sequence[str] = (*STAR_TABLES, *MART_TABLES),
    engine: str | None = "MergeTree",
    connections: int | None = None,
    mode: str = "overwrite",
) -> None:
    """Write the stored tables to the database's, after checking that it answers: in place of their rows, or with
    ``mode="append"`` into tables that the caller has emptied, where Spark can't empty them without dropping them."""
    require_jdbc(spark, url, properties)
    for name in names:
        rows = read_star_or_mart(spark, root, name)
        write_table(rows, url, prefix + name, properties, SORT_KEYS[name], mode, engine, connections)
