"""Training-data pipeline over ``documents``: quality, line dedup, near duplicates, decontamination, packing."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.llm import decontam, linededup, neardup, packing, quality
from farelake.llm.common import find_package, read, stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Vocabulary that the last stage packs with; the file of the public_tokenizers package where unset.
VOCABULARY = os.environ.get("PACKING_VOCABULARY", "")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the hierarchical quality classifier doesn't reject."""
    return quality.grade(docs, read(spark, sf_dir, "labels")).where("kept").select(*COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without runs of lines that an earlier one has; a document may become empty."""
    left = linededup.dedup_lines(docs)
    return left.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each group of near duplicates (five words, similarity 0.8)."""
    find_package(spark)
    return neardup.drop_near_duplicates(docs).select(*COLUMNS)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontam.drop_contaminated(docs, read(spark, sf_dir, "benchmark")).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 tokens."""
    find_package(spark)
    vocabulary = VOCABULARY
    if not vocabulary:
        import public_tokenizers

        vocabulary = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack_documents(docs, vocabulary)


STAGES = [
    ("quality", keep_quality),
    ("line_dedup", drop_repeated_lines),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("packing", pack_sequences),
]

#: Fitted models and token ids can't be expressed in SQL; tests hold each stage to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each stage's output is stored before the next one reads it."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
