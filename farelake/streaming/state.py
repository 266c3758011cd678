"""Where a stateful stream keeps its state."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# RocksDB: state on the executors' disks, so it may outgrow their memory; each batch writes only its changes to the
# checkpoint. The memory of all stores of an executor together is bounded.
DISK_STATE = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "400",
    # Else each store sets some MB of disk aside for its log, however little it holds.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


@contextmanager
def disk_state(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state on disk; the session's own settings come back afterwards. A query that
    goes on from a checkpoint keeps the kind of state that it began with."""
    before = {key: spark.conf.get(key, None) for key in DISK_STATE}
    for key, value in DISK_STATE.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
