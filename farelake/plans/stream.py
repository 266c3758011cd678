"""Speed layer: one trip stream, two queries: enriched rows, and trips per ten minutes."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from farelake.operators.clean import conform_trips
from farelake.sinks.batches import append_once
from farelake.sinks.streams import append_stream, publish_batches, triggered
from farelake.sinks.upsert import append_documents, upsert_batches, upsert_documents
from farelake.sources.files import mixed_batches
from farelake.streaming.enrich import enrich_batches, enrich_with_zones
from farelake.streaming.state import disk_state
from farelake.streaming.summary import StreamRun, summarised
from farelake.streaming.windows import WINDOW_KEYS, window_counts, with_event_time

OUTPUT_MODES = ("complete", "update", "append")


@dataclass(frozen=True)
class StreamTargets:
    """Where the two queries write and keep their checkpoints."""

    enriched: str
    counts: str
    checkpoints: str


def start_enriched(
    trips: DataFrame,
    locations: DataFrame | Callable[[], DataFrame],
    target: str | None,
    checkpoint: str,
    interval: str | None = None,
    source: str = "parquet",
    write: Callable[[DataFrame, int], None] | None = None,
    **options: str,
) -> StreamingQuery:
    """Append the trips with their pickup zone's columns.

    ``locations`` is the zone table as it is at the start, or a function that reads it: that runs for each batch, so
    changes and growth of the table count while the stream goes on. With ``write``, a function of each enriched batch
    that may get one twice, the rows go there; else to files at ``target``, each once.
    """
    if not callable(locations) and write is None:
        return append_stream(enrich_with_zones(trips, locations), checkpoint, target, source, interval, **options)
    enrich = enrich_batches(locations if callable(locations) else lambda: locations)
    if write is None:
        each = append_once(target, checkpoint, prepare=enrich)
    else:
        each = lambda batch, batch_id: write(enrich(batch), batch_id)
    writer = trips.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return triggered(writer, interval).start()


def start_window_counts(
    trips: DataFrame,
    checkpoint: str,
    write: Callable[[DataFrame, int], None],
    output_mode: str = "complete",
    interval: str | None = None,
    event_time: str = "tpep_pickup_datetime",
    width: str = "10 minutes",
    watermark: str | None = "30 minutes",
) -> StreamingQuery:
    """Upsert the trips per window of every batch.

    Counts all trips, also those whose zone is unknown. Complete mode keeps every window in the state
    and hands all of them to each batch; update mode hands over changed windows only, drops rows later
    than the watermark, and its state stays small however long the query runs. Without a watermark no
    row is late: use that to replay what has an end. The state lies on the executors' disks.
    """
    if output_mode not in OUTPUT_MODES:
        raise ValueError(f"output mode is one of {OUTPUT_MODES}, not {output_mode!r}")
    counts = window_counts(with_event_time(trips, event_time), "pickup_ts", width, watermark)
    writer = counts.writeStream.outputMode(output_mode).foreachBatch(write)
    with disk_state(trips.sparkSession):
        return triggered(writer.option("checkpointLocation", checkpoint), interval).start()


def wait_all(spark: SparkSession, *queries: StreamingQuery) -> None:
    """Wait until all queries have ended; when one fails stop the others and raise its error."""
    try:
        while any(q.isActive for q in queries):
            spark.streams.awaitAnyTermination()
            spark.streams.resetTerminated()
        for query in queries:
            query.awaitTermination()
    finally:
        for query in queries:
            query.stop()


def run_stream(
    trips: DataFrame,
    locations: DataFrame | Callable[[], DataFrame],
    targets: StreamTargets,
    output_mode: str = "complete",
    interval: str | None = None,
    event_time: str = "tpep_pickup_datetime",
    width: str = "10 minutes",
    watermark: str | None = "30 minutes",
    documents: tuple[str, str] | None = None,
) -> dict[str, StreamRun]:
    """Both queries of the speed layer, until the first failure or, without an interval, the end; what they did.

    With ``documents``, the URI and database of a document store, the targets name its collections. ``locations`` as a
    function is read again for each batch.
    """
    whole = output_mode == "complete"
    day = {} if whole else {"day": WINDOW_KEYS[0]}
    write = upsert_batches(targets.counts, WINDOW_KEYS, whole, **day)
    checkpoint, append = f"{targets.checkpoints}/enriched", None
    if documents:
        write = upsert_documents(*documents, targets.counts, WINDOW_KEYS)
        append = append_documents(*documents, targets.enriched, checkpoint)
    # A query of the session that has failed before would be told as this run's failure.
    trips.sparkSession.streams.resetTerminated()
    with summarised(trips.sparkSession) as summary:
        counts = start_window_counts(
            trips, f"{targets.checkpoints}/counts", write, output_mode, interval, event_time, width, watermark
        )
        try:
            enriched = start_enriched(trips, locations, targets.enriched, checkpoint, interval, write=append)
        except Exception:
            counts.stop()
            raise
        wait_all(trips.sparkSession, counts, enriched)
        return {"counts": summary.of(counts), "enriched": summary.of(enriched)}


def run_replay(
    trips: DataFrame,
    servers: str,
    topic: str,
    schema_id: int,
    checkpoint: str,
    interval: str | None = "10 seconds",
    partitions: int | None = None,
    version: int = 2,
    schema: str | None = None,
    mixed: bool = False,
) -> StreamingQuery:
    """Publish a stream of trip files as keyed Avro messages of either version, one batch per trigger.

    ``schema`` is the text that ``schema_id`` stands for; by default that of the message version. With ``mixed`` the
    stream is one of file names, whose files may differ in physical type (``replay_file_names``).
    """
    publish = publish_batches(servers, topic, schema_id, partitions, version=version, schema=schema)
    rows, write = (trips, mixed_batches(publish)) if mixed else (conform_trips(trips), publish)
    writer = rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return triggered(writer, interval).start()
