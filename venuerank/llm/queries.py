"""Queries of the training-data operators, each over its whole table, and SQL where it can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from venuerank.llm import bpe, exact_dedup, near_dup, nearest, packing, pieces, quality, sharding, spelling, suffix_dedup, toxicity, warc, whitening


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(_table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256"
    )


def op2_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encoded(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(_table(spark, sf_dir, "pages")).drop("payload", "url")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_groups(_table(spark, sf_dir, "documents")).drop("digest")


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.kd_shards(_table(spark, sf_dir, "documents"), shards=8).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity.score_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return found.select("doc_id", "held_out", "score", "predicted")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.with_passages(_table(spark, sf_dir, "documents"))


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return nearest.nearest(vectors, vectors.filter(F.col("vec_id") % 20 == 0), 20)


def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trips(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(_table(spark, sf_dir, "embeddings"), components=4)


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.grouped_variants(_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_exact_dedup, op2_pieces, op3_warc, op4_quality, op5_near_dup, op6_sharding, op7_toxicity, op8_packing, op9_suffix_dedup, op10_nearest,
    op11_bpe, op12_whitening, op13_spelling,
)}

ORACLES = {
    "op1_exact_dedup": r"""
        WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
        SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = min(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
        FROM d WINDOW w AS (PARTITION BY norm)
    """,
}
