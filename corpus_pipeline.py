"""A corpus from raw documents to training sequences.

Each stage takes (spark, docs, sf_dir), works on every row its predecessor kept, and is written as
Parquet to the shared folder before the next one reads it. All but the last return the columns of
documents. Rows with nulls, empty texts, repeated rows and further columns pass as the operators
define; an empty table gives no rows.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from venuerank.llm import exact_dedup, near_dup, packing, suffix_dedup, toxicity
from venuerank.session import materialise


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go; labels come from the corpus's own table."""
    return toxicity.keep_clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts, the one with the smallest doc_id stays."""
    return exact_dedup.keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents, the one with the smallest doc_id stays."""
    return near_dup.keep_one(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages of over 50 words, or of 400 bytes, leave the texts; n_chars follows. A text that was all repeats stays as an empty one."""
    cut = suffix_dedup.without_passages(docs, carry=docs.columns)
    text, n_chars = F.col("kept_text"), F.when(F.col("n_removed") > 0, F.length("kept_text").cast("long")).otherwise(F.col("carried.n_chars"))
    new = {"text": text} | ({"n_chars": n_chars} if "n_chars" in docs.columns else {})
    return cut.select(*[new.get(c, F.col("carried").getField(c)).alias(c) for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of every document, packed into sequences."""
    return packing.packed(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("suffix_dedup", cut_repeats),
    ("packing", pack),
]

# scores of a trained model, MinHash links and tokens can't be said in SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
