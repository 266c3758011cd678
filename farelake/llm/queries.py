"""The operators' queries over the given tables, and their SQL where SQL can express them."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    decontam,
    exactdedup,
    imatch,
    licenses,
    linededup,
    merkle,
    neardup,
    packing,
    periodic,
    quality,
    recompress,
    sharding,
    toxicity,
)
from .common import read, words


def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return linededup.dedup_lines(docs).select("doc_id", "n_lines", "n_removed", "text")


def substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return recompress.drop_repeats(docs, whole=False).withColumnRenamed("kept", "kept_sha256")


def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.scan_licenses(docs, licenses.known_digests(spark))


def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    lexicon = toxicity.learn(docs, read(spark, sf_dir, "labels").where(~held_out))
    return toxicity.score_texts(docs, lexicon).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.compare_edited(read(spark, sf_dir, "documents").select("doc_id", "text"))


def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return neardup.near_duplicates(docs).select("doc_id", "n_shingles", "component_id", "kept")


def quality_grades(spark: SparkSession, sf_dir: str) -> DataFrame:
    graded = quality.grade(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return graded.select("doc_id", "host", "path", "logit", "probability", "kept")


def packing_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = read(spark, sf_dir, "documents")
    pieces = packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontam.overlaps(docs, read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "start", "length", "similarity")


def shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    text_crc32 = F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32")
    return sharding.shuffle_into_shards(docs).select(
        "doc_id", "size", text_crc32, "law", "shard", "slot", "grown_shard"
    )


def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exactdedup.exact_duplicates(spark, f"{sf_dir}/documents.parquet")
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def _id_crc32() -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary"))


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``; a tenth of the texts repeat a piece of themselves from some word to the end."""
    h = _id_crc32()
    g = F.floor(h / 10)
    rows = docs.select("doc_id", "text", F.when(h % 10 == 0, words(F.col("text"))).alias("w"), g.alias("g"))
    rows = rows.withColumn("n", F.when(F.size("w") > 0, F.size("w").cast("long")))
    rows = rows.withColumn("a", F.col("g") % F.col("n"))
    rows = rows.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    first, piece, rest = (F.col(c).cast("int") for c in ("a", "p", "n"))
    times = F.ceil((rest - first) / piece).cast("int")
    again = F.slice(F.flatten(F.array_repeat(F.slice("w", first + 1, piece), times)), 1, rest - first)
    planted = F.array_join(F.concat(F.slice("w", 1, first), again), " ")
    return rows.select("doc_id", F.when(F.col("n").isNotNull(), planted).otherwise(F.col("text")).alias("text"))


def period_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = periodic.periodic_runs(with_planted_periods(docs)).withColumn("top", periodic.strongest(F.col("runs")))
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    lines = F.array_join(F.transform(line, lambda x: F.concat(x, F.lit("\n"))), "")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("top.start").alias("start"),
        F.col("top.length").alias("length"),
        F.col("top.period").alias("period"),
        F.expr("1000 * top.length div top.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def merkle_proofs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    folded = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    tampered = F.when(_id_crc32() % 3 == 0, folded).otherwise(F.col("text"))
    given = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    leaves = docs.select(
        "lang",
        "doc_id",
        merkle.leaf(*given, F.col("text")).alias("leaf"),
        merkle.leaf(*given, tampered).alias("tampered"),
    )
    found = merkle.merkle_manifest(leaves, "lang", "doc_id", ["tampered"])
    found = found.withColumn("folded_root", merkle.fold(F.col("tampered"), F.col("path")))
    return found.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        merkle.proof(F.col("path")).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": line_dedup,
    "op2_toxicity": toxicity_scores,
    "op3_document_fingerprints": document_fingerprints,
    "op4_near_duplicates": near_duplicates,
    "op5_substring_dedup": substring_dedup,
    "op6_license_scan": license_scan,
    "op7_quality": quality_grades,
    "op8_packing": packing_query,
    "op9_decontamination": decontamination,
    "op10_sharding": shards,
    "op11_exact_dedup": exact_dedup,
    "op12_periodic_runs": period_runs,
    "op13_merkle_manifest": merkle_proofs,
}

ORACLE: dict[str, str] = {
    "op1_line_dedup": linededup.LINE_SQL,
    "op6_license_scan": licenses.license_sql(),
    "op11_exact_dedup": exactdedup.EXACT_SQL,
    "op13_merkle_manifest": merkle.manifest_sql(),
}
