"""Names for rows that have no key of their own."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Equal rows that one task of a batch numbers.
RUN = 100_000


def with_row_ids(rows: DataFrame, prefix: str, name: str = "_id", run: int = RUN) -> DataFrame:
    """``rows`` with ``name``: ``prefix``, a digest of the row's content, and its number among equal rows.

    The same rows get the same names however they are partitioned, so writing them again by name changes nothing. Equal
    rows are counted, which Spark combines before the shuffle, and made again in runs of ``run``: a row that a third of
    the table repeats is numbered by many tasks.
    """
    columns = rows.columns
    # Nulls have to show: concat_ws would skip them.
    content = F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)
    counted = rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("_times"))
    runs = counted.withColumn("_first", F.explode(F.sequence(F.lit(0), F.col("_times") - 1, F.lit(run))))
    # By number, as the runs of one row take little room until they are made rows again.
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = runs.withColumn("_content", content).repartition(parts, "_content", "_first")
    last = F.least(F.col("_first") + run, "_times") - 1
    numbered = spread.withColumn("_number", F.explode(F.sequence("_first", last)))
    return numbered.select(F.concat_ws("-", F.lit(prefix), "_content", "_number").alias(name), *columns)
