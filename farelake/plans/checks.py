"""The registered queries: every operator run over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.functions.keys import epoch_millis, trip_key
from farelake.operators import marts, star
from farelake.operators.clean import clean_trips, conform_trips
from farelake.operators.keys import with_dense_key
from farelake.plans import serving
from farelake.plans.batch import build_marts, build_star, run_batch_on
from farelake.plans.loads import load_trips, read_loaded
from farelake.plans.stream import StreamTargets, run_stream, start_window_counts
from farelake.schemas import MART_TABLES, SORT_KEYS, TRIP_V2
from farelake.session import scratch_path, zoned_session
from farelake.sinks.batches import append_once
from farelake.sinks.streams import land_partitioned, land_text, publish_batches
from farelake.sinks.tables import read_star_or_mart, write_star_or_mart
from farelake.sinks.upsert import read_upserted, upsert_batches
from farelake.sources.envelope import decode_envelope
from farelake.sources.files import mixed_batches, read_trips, replay_file_names, replay_trips
from farelake.sources.testtables import trips_from_lineitem, zones_from_part
from farelake.streaming.summary import summarised, summary_rows
from farelake.streaming.windows import WINDOW_KEYS, window_counts, with_event_time

Query = Callable[[SparkSession, str], DataFrame]

# The test tables hold wall-clock times without a zone; they are read as UTC.
ZONE = "UTC"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stream_of(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table as a file stream; a table is one file, or a folder of files."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = spark.read.parquet(path).schema
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.getFileStatus(hadoop).isDirectory():
        return replay_trips(spark, path, schema, max_files=1000, latest_first=False)
    return replay_trips(spark, sf_dir, schema, latest_first=False, pathGlobFilter=f"{name}.parquet")


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips_from_lineitem(table(spark, sf_dir, "lineitem"))


def cleansed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_trips(conform_trips(raw_trips(spark, sf_dir)))


def locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.dim_location(zones_from_part(table(spark, sf_dir, "part")))


MIXED_FOLDERS = 3


def write_mixed_trips(spark: SparkSession, sf_dir: str) -> str:
    """Raw trips in three folders whose files have other physical types, as older months have; returns their parent."""
    work = scratch_path(spark, "mixed")
    lineitem = table(spark, sf_dir, "lineitem")
    wide = dict.fromkeys(("VendorID", "PULocationID", "DOLocationID", "payment_type"), "bigint")
    wide |= dict.fromkeys(("passenger_count", "RatecodeID"), "double")
    narrow = dict.fromkeys(("VendorID", "passenger_count", "RatecodeID", "payment_type"), "int")
    narrow |= dict.fromkeys(("extra", "mta_tax", "tolls_amount"), "float")
    for folder, kinds in enumerate(({}, wide, narrow)):
        trips = trips_from_lineitem(lineitem.where(F.pmod("l_orderkey", F.lit(MIXED_FOLDERS)) == folder))
        trips = trips.withColumns({name: F.col(name).cast(kind) for name, kind in kinds.items()})
        if kinds is narrow:
            trips = trips.withColumnRenamed("Airport_fee", "airport_fee").drop("cbd_congestion_fee")
        trips.write.parquet(f"{work}/{folder}")
    return work


def mixed_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trip folders of three physical types, read as one table and cleansed."""
    return clean_trips(read_trips(spark, write_mixed_trips(spark, sf_dir), mixed=True))


def mixed_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same folders replayed a few files at a time; the rows of all batches."""
    session = zoned_session(spark, ZONE)
    work = scratch_path(session, "mixed-replay")
    names = replay_file_names(session, write_mixed_trips(session, sf_dir), max_files=4, latest_first=False)
    write = append_once(f"{work}/trips", f"{work}/checkpoint")
    (
        names.writeStream.foreachBatch(mixed_batches(write))
        .option("checkpointLocation", f"{work}/checkpoint")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return session.read.parquet(f"{work}/trips")


def fact(spark: SparkSession, sf_dir: str, times: DataFrame | None = None) -> DataFrame:
    lookups = (star.dim_vendor(spark), star.dim_ratecode(spark), star.dim_payment(spark))
    return star.fact_trip(cleansed(spark, sf_dir), *lookups, locations(spark, sf_dir), times)


def times_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.dim_time(cleansed(spark, sf_dir))


def fact_without_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact(spark, sf_dir).drop("fact_trip_sk")


def stored_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The time dimension, stored and read back."""
    root = scratch_path(spark, "times")
    write_star_or_mart(times_of(spark, sf_dir), root, "dim_time")
    return read_star_or_mart(spark, root, "dim_time")


def fact_star_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact(spark, sf_dir, stored_times(spark, sf_dir)).drop("fact_trip_sk")


def lookup_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips per vendor, rate and payment name: every row of the three literal dimensions in use."""
    counts = fact(spark, sf_dir).groupBy("vendor_sk", "ratecode_sk", "payment_type_sk").agg(F.count("*").alias("trips"))
    rates = star.dim_ratecode(spark).withColumnRenamed("description", "rate_description")
    payments = star.dim_payment(spark).withColumnRenamed("description", "payment_description")
    return (
        counts.join(star.dim_vendor(spark), F.col("vendor_sk") == F.col("vendor_id"), "left")
        .join(rates, F.col("ratecode_sk") == F.col("rate_code_id"), "left")
        .join(payments, F.col("payment_type_sk") == F.col("payment_id"), "left")
        .select(
            "vendor_id",
            "provider_name",
            "rate_code_id",
            "rate_code_name",
            "rate_description",
            "payment_id",
            "payment_type_name",
            "payment_description",
            "trips",
        )
    )


def message_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trips per message key, with the span of their times in epoch milliseconds."""
    trips = raw_trips(zoned_session(spark, ZONE), sf_dir)
    return trips.groupBy(trip_key().alias("key")).agg(
        F.count("*").alias("messages"),
        F.min(epoch_millis("tpep_pickup_datetime")).alias("first_pickup_ms"),
        F.max(epoch_millis("tpep_dropoff_datetime")).alias("last_dropoff_ms"),
    )


def event_window_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return window_counts(table(spark, sf_dir, "events"), "ts").drop("window_ts")


def _stream_counts(spark: SparkSession, sf_dir: str, output_mode: str) -> DataFrame:
    """Window counts of a replay from its first file to its last: no row is late, in however many batches."""
    session = zoned_session(spark, ZONE)
    work = scratch_path(session, "counts")
    whole = output_mode == "complete"
    write = upsert_batches(f"{work}/table", WINDOW_KEYS, whole, None if whole else WINDOW_KEYS[0])
    events = stream_of(session, sf_dir, "events")
    start_window_counts(
        events, f"{work}/checkpoint", write, output_mode, event_time="ts", watermark=None
    ).awaitTermination()
    return read_upserted(session, f"{work}/table").select("window_start", "window_end", "trip_count")


def stream_window_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stream_counts(spark, sf_dir, "complete")


def stream_window_counts_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stream_counts(spark, sf_dir, "update")


LATE_BATCHES, LATE_FILES = 4, 8


def _late_counts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[tuple[str, int, int, int]]]:
    """Window counts in update mode with a watermark, over four batches that each span all times; what the query did.

    Spark tests the rows of a batch with the watermark that the batch before it started with, so the first two batches
    count whole and the later ones only in windows that end after the watermark.
    """
    session = zoned_session(spark, ZONE)
    work = scratch_path(session, "late")
    events = table(session, sf_dir, "events")
    for batch in range(LATE_BATCHES):
        rows = events.where(F.pmod("event_id", F.lit(LATE_BATCHES)) == batch)
        rows.repartition(LATE_FILES).write.mode("append").parquet(f"{work}/in")
    stream = replay_trips(session, f"{work}/in", events.schema, max_files=LATE_FILES, latest_first=False)
    write = upsert_batches(f"{work}/table", WINDOW_KEYS, day=WINDOW_KEYS[0])
    with summarised(session) as summary:
        query = start_window_counts(stream, f"{work}/checkpoint", write, "update", event_time="ts")
        query.awaitTermination()
        done = summary_rows(summary, [("window_counts", query)])
    return read_upserted(session, f"{work}/table"), done


def stream_late_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _late_counts(spark, sf_dir)[0].select("window_start", "window_end", "trip_count")


def stream_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the query of ``stream_late_counts`` did: batches, rows, late windows, and rows that are in no window."""
    counts, done = _late_counts(spark, sf_dir)
    counted = counts.agg(F.sum("trip_count")).head()[0] or 0
    return spark.createDataFrame(
        [(*row, row[2] - counted) for row in done],
        "query string, batches long, rows_in long, late_windows long, late_rows long",
    )


def _speed_layer(spark: SparkSession, sf_dir: str) -> tuple[SparkSession, StreamTargets]:
    """Outputs of the speed layer over the raw trips, run anew for each query."""
    session = zoned_session(spark, ZONE)
    work = scratch_path(session, "speed")
    targets = StreamTargets(f"{work}/enriched", f"{work}/counts", f"{work}/checkpoints")
    trips = trips_from_lineitem(stream_of(session, sf_dir, "lineitem"))
    run_stream(trips, locations(session, sf_dir), targets)
    serving.register_views(session, targets.enriched, targets.counts)
    return session, targets


def stream_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    session, targets = _speed_layer(spark, sf_dir)
    return session.read.parquet(targets.enriched)


def _served(query: Callable[[SparkSession], DataFrame]) -> Query:
    return lambda spark, sf_dir: query(_speed_layer(spark, sf_dir)[0])


def landed_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trips landed under year, month and day of pickup, read back whole with their folders."""
    session = zoned_session(spark, ZONE)
    work = scratch_path(session, "landed")
    trips = trips_from_lineitem(stream_of(session, sf_dir, "lineitem"))
    # The test trips are in no order of time.
    land_partitioned(trips, f"{work}/trips", f"{work}/checkpoint", None, unordered=True).awaitTermination()
    return session.read.parquet(f"{work}/trips")


def landed_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events landed as text lines, read back line by line."""
    session = zoned_session(spark, ZONE)
    work = scratch_path(session, "text")
    events = stream_of(session, sf_dir, "events")
    lines = events.select(F.concat_ws("|", "event_id", "event_type", "user_id").alias("value"))
    land_text(lines, f"{work}/lines", f"{work}/checkpoint", interval=None).awaitTermination()
    return session.read.text(f"{work}/lines")


def _json_record(record: Column, schema: str) -> Column:
    return F.to_json(record).cast("binary")


def _from_json_record(record: Column, schema: str, options: dict[str, str]) -> Column:
    return F.from_json(record.cast("string"), TRIP_V2, options)


def replayed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trips replayed as framed messages, decoded again and summed per key.

    JSON and Parquet stand in for Avro and Kafka, whose packages a plain installation lacks.
    """
    session = zoned_session(spark, ZONE)
    work = scratch_path(session, "replay")
    publish = publish_batches("", "", 7, source="parquet", encode=_json_record, path=f"{work}/topic")
    trips = trips_from_lineitem(stream_of(session, sf_dir, "lineitem"))
    (
        trips.writeStream.foreachBatch(publish)
        .option("checkpointLocation", f"{work}/checkpoint")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    messages = session.read.parquet(f"{work}/topic")
    decoded = decode_envelope(messages, "", decode=_from_json_record)
    return decoded.groupBy(trip_key().alias("key")).agg(
        F.count("*").alias("messages"),
        F.sum(F.unix_millis("tpep_dropoff_datetime")).alias("dropoff_ms"),
        F.sum(F.rint(F.col("total_amount") * 100).cast("bigint")).alias("total_cents"),
    )


def batch_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole batch layer, stored; rows per table."""
    root = scratch_path(spark, "warehouse")
    return run_batch_on(spark, raw_trips(spark, sf_dir), locations(spark, sf_dir), root).summary


def _loaded(name: str) -> Query:
    """A table after two loads: the trips of odd orders first, then those of even ones, over the same days."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = scratch_path(spark, "loads")
        lineitem, zones = table(spark, sf_dir, "lineitem"), locations(spark, sf_dir)
        wanted = [name] if name in MART_TABLES else []
        for load, rest, names in (("first", 1, []), ("second", 0, wanted)):
            trips = trips_from_lineitem(lineitem.where(F.col("l_orderkey") % 2 == rest))
            load_trips(spark, trips, zones, root, load, names)
        return read_loaded(spark, root, name).drop("fact_trip_sk")

    return query


LOADED_TABLES = ("dim_time", "agg_daily_trips", "agg_popular_routes", "agg_revenue_breakdown")


def dense_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact with its dense surrogate key."""
    return with_dense_key(fact(spark, sf_dir), "fact_trip_sk", SORT_KEYS["fact_trip"])


def _stored(name: str) -> Query:
    """A table as the batch job stores it, read back."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = scratch_path(spark, "warehouse")
        build_star(spark, raw_trips(spark, sf_dir), locations(spark, sf_dir), root)
        if name in MART_TABLES:
            build_marts(spark, root, names=[name])
        return read_star_or_mart(spark, root, name).drop("fact_trip_sk")

    return query


QUERIES: dict[str, Query] = {
    "clean_trips": cleansed,
    "mixed_trips": mixed_trips,
    "mixed_replay": mixed_replay,
    "dim_time": times_of,
    "dim_location": locations,
    "lookup_usage": lookup_usage,
    "fact_trip": fact_without_key,
    "fact_trip_star_join": fact_star_join,
    "mart_daily_trips": lambda s, d: marts.daily_trips(fact(s, d)),
    "mart_hourly_patterns": lambda s, d: marts.hourly_patterns(fact(s, d)),
    "mart_pickup_locations": lambda s, d: marts.pickup_locations(fact(s, d), locations(s, d)),
    "mart_dropoff_locations": lambda s, d: marts.dropoff_locations(fact(s, d), locations(s, d)),
    "mart_vendor_performance": lambda s, d: marts.vendor_performance(fact(s, d), star.dim_vendor(s)),
    "mart_payment_analysis": lambda s, d: marts.payment_analysis(fact(s, d), star.dim_payment(s)),
    "mart_popular_routes": lambda s, d: marts.popular_routes(fact(s, d), locations(s, d)),
    "mart_revenue_breakdown": lambda s, d: marts.revenue_breakdown(fact(s, d)),
    "mart_daily_trips_star_join": lambda s, d: marts.daily_trips(fact(s, d), stored_times(s, d)),
    "mart_hourly_patterns_star_join": lambda s, d: marts.hourly_patterns(fact(s, d), stored_times(s, d)),
    "mart_vendor_performance_star_join": lambda s, d: marts.vendor_performance(
        fact(s, d), star.dim_vendor(s), stored_times(s, d)
    ),
    "mart_payment_analysis_star_join": lambda s, d: marts.payment_analysis(
        fact(s, d), star.dim_payment(s), stored_times(s, d)
    ),
    "mart_revenue_breakdown_star_join": lambda s, d: marts.revenue_breakdown(fact(s, d), stored_times(s, d)),
    "batch_summary": batch_summary,
    "event_window_counts": event_window_counts,
    "stream_window_counts": stream_window_counts,
    "stream_window_counts_update": stream_window_counts_update,
    "stream_late_counts": stream_late_counts,
    "stream_summary": stream_summary,
    "stream_enriched": stream_enriched,
    "serve_total": _served(serving.total_trips),
    "serve_window_series": _served(serving.window_series),
    "serve_by_vendor": _served(serving.trips_by_vendor),
    "serve_revenue_by_dropoff": _served(serving.revenue_by_dropoff),
    "serve_distance_tip": _served(serving.distance_and_tip),
    "message_keys": message_keys,
    "replayed_messages": replayed_messages,
    "landed_days": landed_days,
    "landed_text": landed_text,
    "stored_fact_trip": _stored("fact_trip"),
    "stored_dim_time": _stored("dim_time"),
    **{f"stored_{name}": _stored(name) for name in MART_TABLES},
    **{f"loaded_{name}": _loaded(name) for name in LOADED_TABLES},
    "fact_trip_dense_key": dense_keys,
}
