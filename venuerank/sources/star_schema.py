"""Venue records derived from an order-processing star schema.

Parts play the venues, line items the reviews, customers the reviewers and documents the
review texts, so that every operator can be compared with SQL over the same tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from venuerank.sources.raw import join_path

AS_OF = "2002-01-01"


def table(spark: SparkSession, base: str, name: str) -> DataFrame:
    return spark.read.parquet(join_path(base, f"{name}.parquet"))


def businesses(spark: SparkSession, base: str) -> DataFrame:
    key = F.col("p_partkey")
    side = key % 2
    town = key % 25
    kind = F.col("p_type")
    categories = (
        F.when(kind == "ECONOMY", "Fast Food, Restaurants")
        .when(kind == "LARGE", "Steakhouses , Restaurants")
        .when(kind == "MEDIUM", "Bars, Nightlife")
        .when(kind == "PROMO", "Active Life, Yoga")
        .when(kind == "SMALL", "Mexican, Restaurants")
        .otherwise("Coffee & Tea")
    )
    return table(spark, base, "part").select(
        key.cast("string").alias("business_id"),
        F.col("p_name").alias("name"),
        F.concat(F.lit(" ciTY "), town.cast("string"), F.lit(" ")).alias("city"),
        F.when(side == 0, "az").otherwise("nv ").alias("state"),
        F.when(key % 41 != 0, 30 + town * 0.23 + (key % 7) * 0.031).cast("double").alias("latitude"),
        (-110 + side * 8 - town * 0.17 - (key % 11) * 0.027).cast("double").alias("longitude"),
        F.when(F.col("p_size") % 7 == 0, 0).otherwise(1).alias("is_open"),
        categories.alias("categories"),
        (5 + F.col("p_size") * 9).cast("long").alias("review_count"),
    )


def reviews(spark: SparkSession, base: str, body: Column | None = None) -> DataFrame:
    """One review per line item, with the whole text of one of all documents.

    `body` takes something short from each document's `text` in its place, worked out once a document; it then meets the
    orders, so that line items are shuffled once and no text is.
    """
    documents = table(spark, base, "documents").select("doc_id", (F.col("text") if body is None else body).alias("body"))
    # one row by construction
    document_count = table(spark, base, "documents").select(F.count(F.lit(1))).scalar()
    orders = table(spark, base, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    quantity = F.col("l_quantity").cast("int")
    review_id = F.concat_ws(
        "-",
        *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")],
        quantity.cast("string"),
    )
    unwritten = (F.col("l_linenumber") == 7) & (F.col("l_quantity") > 45)
    doc_id = F.col("l_orderkey") % document_count
    lines = table(spark, base, "lineitem")
    if body is None:
        written = lines.join(orders, "l_orderkey").withColumn("doc_id", doc_id).join(documents, "doc_id")
    else:
        written = lines.join(orders.withColumn("doc_id", doc_id).join(documents, "doc_id").drop("doc_id"), "l_orderkey")
    return written.select(
        review_id.alias("review_id"),
        F.col("l_partkey").cast("string").alias("business_id"),
        F.col("o_custkey").cast("string").alias("user_id"),
        (1 + (quantity - 1) % 5).alias("stars"),
        F.date_format("l_shipdate", "yyyy-MM-dd 00:00:00").alias("date"),
        F.when(~unwritten, F.col("body")).alias("text"),
    )


def judged_documents(spark: SparkSession, base: str) -> DataFrame:
    """Documents with a quality label, as reviews of five stars or one."""
    labels = table(spark, base, "labels").select("doc_id", "quality")
    return (
        table(spark, base, "documents").select("doc_id", "text")
        .join(labels, "doc_id")
        .select(
            F.col("doc_id").cast("string").alias("review_id"),
            "text",
            F.when(F.col("quality") == 1, 5).otherwise(1).alias("stars"),
        )
    )
