"""What streaming queries did: rows in, rows too late, batches."""

from __future__ import annotations

import threading
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


@dataclass
class StreamRun:
    """Totals of one run of a query. ``late`` counts what its state dropped behind the watermark, one for each key and
    batch, as Spark has combined the rows of a key by then. Batches without rows don't count."""

    rows_in: int = 0
    late: int = 0
    batches: int = 0
    error: str | None = None
    ended: threading.Event = field(default_factory=threading.Event, repr=False)


class StreamSummary(StreamingQueryListener):
    """Adds up the progress of all queries of a session, by run."""

    def __init__(self) -> None:
        self._runs: dict[str, StreamRun] = {}
        self._lock = threading.Lock()

    def _run(self, run_id: object) -> StreamRun:
        with self._lock:
            return self._runs.setdefault(str(run_id), StreamRun())

    def of(self, query: StreamingQuery, timeout: float = 60) -> StreamRun:
        """The totals of a query that has ended. Events come after the fact, its end as the last."""
        run = self._run(query.runId)
        if not run.ended.wait(timeout):
            raise TimeoutError(f"no word of the end of query {query.id}")
        return run

    def onQueryStarted(self, event) -> None:
        self._run(event.runId)

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        run = self._run(progress.runId)
        run.rows_in += progress.numInputRows
        run.late += sum(state.numRowsDroppedByWatermark for state in progress.stateOperators)
        run.batches += progress.numInputRows > 0

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        run = self._run(event.runId)
        run.error = event.exception
        run.ended.set()


@contextmanager
def summarised(spark: SparkSession) -> Iterator[StreamSummary]:
    """Listens to the session's queries while the block runs."""
    summary = StreamSummary()
    spark.streams.addListener(summary)
    try:
        yield summary
    finally:
        spark.streams.removeListener(summary)


def summary_rows(summary: StreamSummary, queries: Sequence[tuple[str, StreamingQuery]]) -> list[tuple[str, int, int, int]]:
    """(name, batches, rows_in, late) of each query."""
    runs = [(name, summary.of(query)) for name, query in queries]
    return [(name, run.batches, run.rows_in, run.late) for name, run in runs]
