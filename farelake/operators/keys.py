"""Dense surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelake.session import scratch_path

_PART_BITS = 33


def with_dense_key(rows: DataFrame, key: str, order_by: Sequence[str]) -> DataFrame:
    """``rows`` with ``key`` as 0, 1, 2 ... in the order of ``order_by`` and then of all other columns, nulls first.

    Equal for any partitioning: rows that only the key could tell apart may change places. The rows are range-shuffled
    once and stored in scratch; the driver sees one count for each partition. Equal rows are split over ranges, so one
    second or one row may hold any share of the table.
    """
    spark = rows.sparkSession
    order = [*order_by, *[c for c in rows.columns if c not in (key, *order_by)]]
    spread = F.xxhash64(F.monotonically_increasing_id())
    ranged = rows.repartitionByRange(*[F.col(c) for c in order], spread).sortWithinPartitions(*order)
    path = scratch_path(spark, "keys")
    ranged.withColumn(key, F.monotonically_increasing_id()).write.parquet(path)
    stored = spark.read.schema(rows.withColumn(key, F.lit(0).cast("long")).schema).parquet(path)
    part = F.shiftright(key, _PART_BITS)
    before, starts = 0, []
    for number, count in stored.groupBy(part.alias("part")).count().orderBy("part").collect():
        starts.append((number, before))
        before += count
    offsets = spark.createDataFrame(starts, "_part long, _start long")
    place = F.col(key).bitwiseAND(F.lit((1 << _PART_BITS) - 1)) + F.col("_start")
    joined = stored.join(F.broadcast(offsets), part == F.col("_part"))
    return joined.select(*[place.alias(key) if c == key else F.col(c) for c in rows.columns])
