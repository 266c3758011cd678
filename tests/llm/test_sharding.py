from collections import Counter

import pytest
from pyspark.sql import functions as F

from farelake.llm import queries
from farelake.llm.sharding import shuffle_into_shards, write_shards


def check(rows, shards):
    for shard in {r.shard for r in rows}:
        assert 0 <= shard < shards
        slots = sorted(r.slot for r in rows if r.shard == shard)
        assert slots == list(range(len(slots)))
    assert all(r.grown_shard in (r.shard, shards) for r in rows)


def test_edge(edge, edge_rows):
    rows = shuffle_into_shards(edge, shards=3).collect()
    check(rows, 3)
    assert Counter((r.doc_id, r.text) for r in rows) == Counter(edge_rows)
    assert all(r["size"] == 16 + len((r.text or "").encode()) for r in rows)
    by_id = {}
    for r in rows:
        assert by_id.setdefault(r.doc_id, r.shard) == r.shard
    assert {"lang", "cls", "W"} <= set(rows[0].asDict())


def test_growth_and_repetition(spark):
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("equal text").alias("text"))
    few = {r.doc_id: r for r in shuffle_into_shards(docs, shards=7).collect()}
    more = {r.doc_id: r.shard for r in shuffle_into_shards(docs, shards=8).collect()}
    check(list(few.values()), 7)
    assert all(more[i] == r.grown_shard for i, r in few.items())
    counts = Counter(r.shard for r in few.values())
    assert max(counts.values()) < 1.3 * min(counts.values())
    again = shuffle_into_shards(docs.repartition(5), shards=7).collect()
    assert all(few[r.doc_id] == r for r in again)
    # The order in a shard is not that of the ids.
    first = [r.doc_id for r in sorted(few.values(), key=lambda r: r.slot) if r.shard == 0]
    assert first != sorted(first) and len(first) > 500


def test_small_buckets_make_the_same_shards(spark):
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.expr("repeat('ab', 500)").alias("text"))
    rows = shuffle_into_shards(docs, shards=4, bucket_bytes=5000).collect()
    check(rows, 4)
    assert {r.doc_id: r.shard for r in rows} == {r.doc_id: r.shard for r in shuffle_into_shards(docs, 4).collect()}


def test_written_files_keep_the_order(spark, edge, tmp_path):
    write_shards(shuffle_into_shards(edge, shards=2), str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert back.count() == edge.count()


def test_empty(empty):
    assert shuffle_into_shards(empty).count() == 0


@pytest.fixture(scope="module")
def whole(spark, small):
    return queries.shards(spark, small).collect()


def test_query(spark, small, whole):
    check(whole, 40)
    docs = spark.read.parquet(f"{small}/documents.parquet")
    want = {
        r.doc_id: (r.n, r.c)
        for r in docs.select("doc_id", (F.octet_length("text") + 16).alias("n"), F.expr("crc32(text)").alias("c")).collect()
    }
    assert {r.doc_id: (r["size"], r.text_crc32) for r in whole} == want


def test_a_row_that_repeats_goes_to_many_tasks(spark):
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") + 10).alias("doc_id"),
        F.when(F.col("id") % 3 == 0, F.lit("same")).otherwise(F.col("id").cast("string")).alias("text"),
    )
    out = shuffle_into_shards(rows, shards=4, bucket_bytes=2000)
    found = out.withColumn("task", F.spark_partition_id()).collect()
    check(found, 4)
    hot = [r for r in found if r.doc_id == 7]
    assert len(hot) == 1000 and len({r.shard for r in hot}) == 1 and len({r.task for r in hot}) > 5
    # Buckets follow each shard's own weight.
    assert len({r.task for r in found if r.shard != hot[0].shard}) < 3 * len({r.task for r in hot})
