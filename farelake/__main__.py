"""Jobs for spark-submit: ``python -m farelake --time-zone Z batch|export|stream|replay|land ...``."""

from __future__ import annotations

import argparse
import json
from functools import partial
from pathlib import Path

from farelake.plans.batch import export_tables, run_batch, run_marts_from_database
from farelake.plans.loads import load_trips
from farelake.plans.stream import StreamTargets, run_replay, run_stream
from farelake.session import build_session
from farelake.sinks.streams import land_partitioned, land_text
from farelake.sinks.tables import summary_of
from farelake.sources.envelope import decode_envelope
from farelake.sources.files import read_trips, read_zones, replay_file_names, replay_trips
from farelake.sources.jdbc import read_table
from farelake.sources.kafka import read_kafka


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="farelake")
    parser.add_argument("--time-zone", required=True, help="zone of the trips' wall-clock times")
    jobs = parser.add_subparsers(dest="job", required=True)

    batch = jobs.add_parser("batch", help="trip files -> star schema and marts")
    batch.add_argument("--trips", required=True)
    batch.add_argument("--zones", required=True)
    batch.add_argument("--root", required=True)
    batch.add_argument("--calendar", choices=["derive", "join"], default="derive")
    batch.add_argument("--by-month", action="store_true", help="store the fact in a folder per pickup month")
    batch.add_argument("--clustered", action="store_true", help="deal the fact to files by ranges of its sort key")
    batch.add_argument("--dense-keys", action="store_true", help="count the fact's surrogate key from 0 in its order")
    batch.add_argument("--load", help="name of this load: add its trips to those of other loads")
    batch.add_argument("--mixed-types", action="store_true", help="columns of the files differ in physical type")

    export = jobs.add_parser("export", help="stored tables -> database")
    export.add_argument("--root", required=True)
    export.add_argument("--url", required=True)
    export.add_argument("--properties", required=True, help="JSON file with user, password and driver")
    export.add_argument("--prefix", default="", help="put before each table name, such as a database and a dot")
    export.add_argument("--engine", default="MergeTree")
    export.add_argument("--connections", type=int)
    export.add_argument("--mode", choices=["overwrite", "append"], default="overwrite")

    marts = jobs.add_parser("marts", help="star schema in a database -> marts")
    marts.add_argument("--url", required=True)
    marts.add_argument("--properties", required=True, help="JSON file with user, password and driver")
    marts.add_argument("--prefix", default="")
    marts.add_argument("--partitions", type=int, default=8, help="parallel reads of the large tables")
    marts.add_argument("--split", choices=["ranges", "quantiles"], default="ranges", help="of time, or of rows")
    marts.add_argument("--root", required=True)

    def topic(job: argparse.ArgumentParser, reads: bool = True) -> None:
        job.add_argument("--servers", required=True)
        job.add_argument("--topic", required=True)
        job.add_argument("--checkpoints", required=True)
        if reads:
            job.add_argument("--starting-offsets", default="latest")

    stream = jobs.add_parser("stream", help="topic -> enriched rows and window counts")
    topic(stream)
    stream.add_argument("--avro-schema", required=True, help="file with the record schema")
    stream.add_argument("--mode", choices=["FAILFAST", "PERMISSIVE"], default="FAILFAST")
    zones = stream.add_mutually_exclusive_group(required=True)
    zones.add_argument("--zones", help="CSV file")
    zones.add_argument("--zones-url", help="database with the location table")
    stream.add_argument("--zones-table", default="dim_location")
    stream.add_argument("--zones-properties", help="JSON file with user, password and driver")
    stream.add_argument("--enriched", required=True)
    stream.add_argument("--counts", required=True)
    stream.add_argument("--output-mode", choices=["complete", "update", "append"], default="complete")
    stream.add_argument("--interval", default="10 seconds")
    stream.add_argument("--watermark", default="30 minutes")
    stream.add_argument("--width", default="10 minutes")
    stream.add_argument("--documents", help="URI of a document store that gets both outputs instead of files")
    stream.add_argument("--database", help="its database; --enriched and --counts then name collections")

    replay = jobs.add_parser("replay", help="trip files -> topic")
    topic(replay, reads=False)
    replay.add_argument("--trips", required=True)
    replay.add_argument("--schema-id", type=int, required=True)
    replay.add_argument("--avro-schema", help="file with the record schema that the id stands for")
    replay.add_argument("--version", type=int, choices=[1, 2], default=2, help="message version")
    replay.add_argument("--partitions", type=int, help="writers at most")
    replay.add_argument("--max-files", type=int)
    replay.add_argument("--max-bytes", type=int)
    replay.add_argument("--oldest-first", action="store_true")
    replay.add_argument("--mixed-types", action="store_true", help="columns of the files differ in physical type")
    replay.add_argument("--interval", default="10 seconds")

    land = jobs.add_parser("land", help="topic -> files by pickup day, or text files")
    topic(land)
    land.add_argument("--path", required=True)
    land.add_argument("--avro-schema", help="file with the record schema; without it the messages land as text")
    land.add_argument("--interval", default="10 minutes")
    land.add_argument("--max-records", type=int, default=1_000_000)
    land.add_argument("--unordered", action="store_true", help="the messages of a batch span many days")
    return parser


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = build_session(f"farelake-{args.job}", args.time_zone)
    if args.job == "batch":
        if args.load:
            trips = read_trips(spark, args.trips, args.mixed_types)
            rows = load_trips(spark, trips, read_zones(spark, args.zones), args.root, args.load)
            summary_of(spark, rows).show(truncate=False)
            return
        run = run_batch(
            spark,
            args.trips,
            args.zones,
            args.root,
            args.calendar,
            args.by_month,
            args.mixed_types,
            args.clustered,
            args.dense_keys,
        )
        run.summary.show(truncate=False)
        return
    if args.job == "export":
        properties = json.loads(Path(args.properties).read_text())
        export_tables(
            spark,
            args.root,
            args.url,
            properties,
            args.prefix,
            engine=args.engine,
            connections=args.connections,
            mode=args.mode,
        )
        return
    if args.job == "marts":
        properties = json.loads(Path(args.properties).read_text())
        run = run_marts_from_database(spark, args.url, properties, args.root, args.prefix, args.partitions, args.split)
        run.summary.show(truncate=False)
        return
    if args.job == "replay":
        files = args.max_files if args.max_files or args.max_bytes else 1
        source = replay_file_names if args.mixed_types else replay_trips
        trips = source(spark, args.trips, max_files=files, max_bytes=args.max_bytes, latest_first=not args.oldest_first)
        run_replay(
            trips,
            args.servers,
            args.topic,
            args.schema_id,
            args.checkpoints,
            args.interval,
            args.partitions,
            args.version,
            Path(args.avro_schema).read_text() if args.avro_schema else None,
            args.mixed_types,
        ).awaitTermination()
        return
    messages = read_kafka(spark, args.servers, args.topic, args.starting_offsets)
    if args.job == "land" and args.avro_schema is None:
        land_text(messages, args.path, args.checkpoints, args.interval).awaitTermination()
        return
    trips = decode_envelope(messages, Path(args.avro_schema).read_text(), getattr(args, "mode", "FAILFAST"))
    if args.job == "land":
        land_partitioned(
            trips, args.path, args.checkpoints, args.interval, args.max_records, args.unordered
        ).awaitTermination()
        return
    if args.zones_url:
        properties = json.loads(Path(args.zones_properties).read_text()) if args.zones_properties else {}
        zones = partial(read_table, spark, args.zones_url, args.zones_table, properties)
    else:
        zones = partial(read_zones, spark, args.zones)  # read again for each batch
    targets = StreamTargets(args.enriched, args.counts, args.checkpoints)
    documents = (args.documents, args.database) if args.documents else None
    run_stream(
        trips,
        zones,
        targets,
        args.output_mode,
        args.interval,
        width=args.width,
        watermark=args.watermark,
        documents=documents,
    )


if __name__ == "__main__":
    main()
