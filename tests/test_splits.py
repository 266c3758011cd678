"""Conditions that split a read of a database into even parts."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from farelake.plans import batch
from farelake.sources.jdbc import split_predicates


def skewed(spark):
    """A fact that grows from month to month, with hot hours, a second that holds a fifth, and nulls."""
    n = 40_000
    rows = spark.range(n).withColumn("u", F.rand(7))
    start = F.lit(datetime(2024, 1, 1))
    at = F.timestamp_add("SECOND", (F.sqrt("u") * 31_000_000 / 3600).cast("int") * 3600 + (F.pow("u", 3) * 600).cast("int"), start)
    hot = F.lit(datetime(2024, 7, 4, 12))
    stamp = F.when(F.col("id") % 50 == 0, F.lit(None)).when(F.col("id") % 5 == 1, hot).otherwise(at)
    return rows.select(F.col("id").alias("fact_trip_sk"), stamp.alias("created_at_sk"))


def parts(rows, predicates):
    return [rows.where(p).count() for p in predicates]


@pytest.mark.parametrize("every", [1, 20])
def test_parts_of_a_skewed_fact_are_even_and_whole(spark, every):
    rows = skewed(spark).persist()
    sample = rows.where(F.col("fact_trip_sk") % every == 0 if every == 1 else F.xxhash64("fact_trip_sk") % every == 0)
    predicates = split_predicates(sample, "created_at_sk", 12, "fact_trip_sk")
    counts = parts(rows, predicates)
    assert sum(counts) == rows.count() and 10 <= len(counts) <= 15
    assert max(counts) <= 2 * min(counts), counts
    marked = rows.select(*[F.coalesce(F.expr(p), F.lit(False)).cast("int").alias(f"p{k}") for k, p in enumerate(predicates)])
    together = sum(F.col(c) for c in marked.columns)
    assert [r[0] for r in marked.select(together).distinct().collect()] == [1]
    rows.unpersist()


def test_whole_numbers_one_part_and_nothing_sampled(spark):
    numbers = spark.range(1000).select((F.col("id") * F.col("id")).alias("v"))
    counts = parts(numbers, split_predicates(numbers, "v", 4))
    assert sum(counts) == 1000 and max(counts) <= 2 * min(counts)
    assert split_predicates(numbers, "v", 1) == split_predicates(numbers.limit(0), "v", 4) == ["1 = 1"]
    nulls = spark.createDataFrame([(None,), (3,), (3,)], "v int")
    assert sum(parts(nulls, split_predicates(nulls, "v", 4))) == 3


def test_bounds_reach_the_reader(spark, monkeypatch):
    rows, read = skewed(spark).persist(), {}
    monkeypatch.setattr(batch, "read_table", lambda spark, url, table, *a: spark.range(0))
    monkeypatch.setattr(batch, "read_sample", lambda spark, url, table, props, column, key, every: rows.select(F.col("created_at_sk").alias(column)))
    monkeypatch.setattr(batch, "read_parts", lambda spark, url, table, props, predicates: read.update({table: predicates}))
    batch.database_star(spark, "jdbc:x", {}, "dw.", partitions=6, split="quantiles")
    assert set(read) == {"dw.fact_trip", "dw.dim_time"}
    counts = parts(rows, read["dw.fact_trip"])
    assert sum(counts) == rows.count() and max(counts) <= 2 * min(counts)
    rows.unpersist()
