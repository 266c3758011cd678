"""Two-pass external shuffle of records into shards.

Pass one scatters records by seeded hashes into buckets that fit in memory; pass two shuffles each bucket with
Fisher-Yates. A shard is a run of buckets, so its order is a uniform shuffle however large it is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import stored, without

OVERHEAD = 16
OFFSETS_BROADCAST = 100_000

_OWN = ["size", "law", "shard", "grown_shard", "slot", "_spread", "_bucket", "_place", "_start"]


def record_size(text: Column) -> Column:
    """Bytes that a record takes: its text in UTF-8 (null: none) and a fixed overhead."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD).cast("long")


def shards_of(doc_id: Column, shards: int, seed: int) -> tuple[Column, Column]:
    """Shard of a record among ``shards``, and among one more: the shard whose hash with the id is largest wins, so
    another shard can only win records for itself."""
    draws = [
        F.struct(F.xxhash64(F.lit(seed), F.lit(k), doc_id).alias("draw"), F.lit(k).alias("shard"))
        for k in range(shards + 1)
    ]
    before = F.array_max(F.array(*draws[:-1]))["shard"]
    after = F.array_max(F.array(*draws))["shard"]
    return before, after


def shuffle_into_shards(
    docs: DataFrame, shards: int = 40, seed: int = 11, bucket_bytes: int = 32 << 20, least_buckets: int = 4
) -> DataFrame:
    """All columns of ``docs``, and ``size``, ``law`` ("key"), ``shard``, ``grown_shard``, ``slot``.

    ``docs`` has ``doc_id`` and ``text``. The shard follows from ``doc_id`` and the number of shards alone. ``slot``
    counts a shard's records from 0 in shuffled order. Buckets hold about ``bucket_bytes`` of records (one record may
    be larger), at least ``least_buckets`` to a shard.

    Null ids are one id like any other. Null texts count as empty. Equal texts spread by their ids. Rows with equal id
    and text are records of their own, which share a shard and not a bucket; where there are such rows, all are
    numbered and stored first, and the order within a shard depends on the partitioning that numbers them. Input columns named like one
    of the result's are replaced. An empty table gives no rows.

    Otherwise the order is a function of the rows and the seed: a task that runs again gives the same records again.
    """
    spread = F.xxhash64(F.lit(seed + 1), "doc_id", "text")
    shard, grown = shards_of(F.col("doc_id"), shards, seed)
    rows = without(docs, _OWN).select(
        "*",
        record_size(F.col("text")).alias("size"),
        F.lit("key").alias("law"),
        shard.alias("shard"),
        grown.alias("grown_shard"),
        spread.alias("_spread"),
    )
    if not rows.groupBy("doc_id", "_spread").count().where("count > 1").isEmpty():
        # Stored, so that both passes see the same numbers.
        number = F.xxhash64("_spread", F.monotonically_increasing_id())
        rows = stored(rows.withColumn("_spread", number), "numbered")
    weights = rows.groupBy("shard").agg(F.sum("size").alias("bytes"))
    heavy = dict(weights.collect())  # a number for each shard
    buckets = [max(least_buckets, -(-heavy.get(k, 0) // bucket_bytes)) for k in range(shards)]
    of = F.get(F.array(*[F.lit(n).cast("long") for n in buckets]), F.col("shard"))
    rows = rows.withColumn("_bucket", F.pmod("_spread", of).cast("int"))

    by_shard = Window.partitionBy("shard").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        rows.groupBy("shard", "_bucket")
        .count()
        .select("shard", "_bucket", F.coalesce(F.sum("count").over(by_shard), F.lit(0)).alias("_start"))
    )
    dealt = rows.repartition(sum(buckets), "shard", "_bucket").sortWithinPartitions(
        "shard", "_bucket", "doc_id", "_spread"
    )
    schema = StructType([*dealt.schema.fields, StructField("_place", LongType())])
    placed = dealt.mapInArrow(_shuffle_buckets(seed), schema)
    if sum(buckets) <= OFFSETS_BROADCAST:  # a row of three numbers for each bucket
        starts = F.broadcast(starts)
    return (
        placed.join(starts, ["shard", "_bucket"])
        .withColumn("slot", F.col("_start") + F.col("_place"))
        .drop("_bucket", "_spread", "_place", "_start")
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """A folder for each shard; rows of a file are in the order of their slots."""
    sharded.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def _shuffle_buckets(seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        bucket = None
        for batch in batches:
            shard, part = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("shard", "_bucket"))
            turns = np.flatnonzero((shard[1:] != shard[:-1]) | (part[1:] != part[:-1])) + 1
            for start, end in zip([0, *turns], [*turns, batch.num_rows], strict=True):
                if start == end:
                    continue
                now = (int(shard[start]), int(part[start]))
                if bucket is not None and now != bucket:
                    yield from _shuffled(held, seed, bucket)
                    held = []
                bucket = now
                held.append(batch.slice(start, end - start))
        if held:
            yield from _shuffled(held, seed, bucket)

    return run


def _shuffled(held: list[pa.RecordBatch], seed: int, bucket: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    """One bucket in Fisher-Yates order: position i, from the last down, changes places with one up to i."""
    table = pa.Table.from_batches(held)
    n = table.num_rows
    rng = np.random.default_rng([seed, *bucket])
    order = np.arange(n)
    partners = rng.integers(0, np.arange(n, 0, -1)) if n else order
    for i, j in zip(range(n - 1, 0, -1), partners, strict=False):
        order[i], order[j] = order[j], order[i]
    for start in range(0, n, 1000):
        chosen = order[start : start + 1000]
        part = table.take(pa.array(chosen)).append_column("_place", pa.array(np.arange(start, start + len(chosen))))
        yield from part.combine_chunks().to_batches()
