"""Raw JSON lines, some of them damaged, through partitioned Parquet and the replacement of one metro, or through the batch run."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from venuerank.plans.batch import BatchOptions, run_batch
from venuerank.session import shared_dir, sibling
from venuerank.sinks.writers import copy_tables, ready_for_serving, replace_partitions, write_parquet
from venuerank.sources.raw import join_path, malformed_lines, read_json, read_table


def write_lines(records: DataFrame, path: str, damaged: Column) -> None:
    """Records as packed JSON lines, a file to a task; of damaged ones the last character is missing."""
    line = F.to_json(F.struct(*records.columns))
    records.select(F.when(damaged, F.substring(line, F.lit(1), F.length(line) - 1)).otherwise(line).alias("value")).write.option("compression", "gzip").text(path)


def _new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def served_tables(businesses: DataFrame, reviews: DataFrame, as_of: str) -> dict[str, DataFrame]:
    """Tables of a batch run over records written as JSON lines, copied and read back; profiles as they are served.

    The stages that fit models aren't run. Empty tables aren't copied, and so aren't among the result.
    """
    spark = sibling(businesses.sparkSession)  # the run sets what it needs on its own session
    raw, gold, copy = (_new_folder(spark, name) for name in ("lines", "batch", "copy"))
    write_lines(businesses, join_path(raw, "business.json"), F.lit(False))
    write_lines(reviews, join_path(raw, "review.json"), F.lit(False))
    rows = run_batch(spark, BatchOptions(raw=raw, output=gold, as_of=as_of, stages=("clean", "aggregate", "profiles")))

    def write(table: DataFrame, name: str) -> None:
        typed = ready_for_serving(table, name) if name == "business_profiles" else table
        write_parquet(typed, join_path(copy, name), "metro_area" if "metro_area" in typed.columns else None, laid_out=True)

    copied = copy_tables(list(rows), lambda name: read_table(spark, gold, name), write)
    return {name: read_table(businesses.sparkSession, copy, name) for name in copied}


def stored_reviews(reviews: DataFrame, metros: DataFrame, damaged: Column, replaced: str) -> tuple[DataFrame, DataFrame]:
    """(reviews by metro as read back, rejected lines).

    `reviews` are written as JSON lines and scanned with the fixed schema; those of a venue in
    `metros(business_id, metro_area)` go to a table by metro, in which the metro `replaced` is then written
    again with five stars throughout. The other metros' files aren't touched.
    """
    spark = reviews.sparkSession
    folder = _new_folder(spark, "round-trip")
    write_lines(reviews, join_path(folder, "review.json"), damaged)
    scanned = read_json(spark, folder, "review.json", "review").filter("review_id IS NOT NULL")
    located = scanned.join(metros.filter("metro_area IS NOT NULL"), "business_id").select("review_id", "user_id", "business_id", "stars", "date", "text", "metro_area")
    table = join_path(folder, "reviews")
    write_parquet(located, table, "metro_area")
    again = located.filter(F.col("metro_area") == replaced).withColumn("stars", F.lit(5.0))
    replace_partitions(again, table, "metro_area")
    return read_table(spark, folder, "reviews"), malformed_lines(spark, folder, "review.json", "review")
