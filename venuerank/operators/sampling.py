"""Splits and samples that repeat whatever the partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from venuerank.functions.hashing import below, draw
from venuerank.session import materialise

_BUCKET_DIGITS = 4  # 65,536 buckets of draws


def split_by_key(df: DataFrame, key: str, fraction: float = 0.8, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Random split decided by each row's key alone; no shuffle."""
    kept = below(draw(F.col(key), seed), fraction)
    return df.filter(kept), df.filter(~kept)


def _ticket(key: str, seed: int) -> Column:
    # the key breaks ties between equal draws
    return F.concat_ws("-", draw(F.col(key), seed), F.col(key).cast("string"))


def _limits(df: DataFrame, key: str, stratum: Column, quota: Column, seed: int) -> DataFrame:
    """(_stratum, _last, _all): the last draw of each stratum that is still in, or that all are.

    Draws are stored once, without the other columns. A histogram of them locates the bucket in
    which the quota is reached; only rows of that bucket are sorted. Memory per task is one
    bucket, a 65,536th of a stratum.
    """
    tickets = materialise(df.select(stratum.alias("_stratum"), _ticket(key, seed).alias("_ticket")), "tickets")
    bucket = F.substring("_ticket", 1, _BUCKET_DIGITS)
    histogram = materialise(
        tickets.groupBy("_stratum", bucket.alias("_bucket")).agg(F.count(F.lit(1)).alias("_rows")), "ticket-counts"
    )
    running = Window.partitionBy("_stratum").orderBy("_bucket")  # at most 65,536 rows
    totals = Window.partitionBy("_stratum")
    edges = (
        histogram.withColumn("_upto", F.sum("_rows").over(running))
        .withColumn("stratum_size", F.sum("_rows").over(totals))
        .withColumn("_quota", quota.cast("long"))
        .filter((F.col("_upto") >= F.col("_quota")) & (F.col("_upto") - F.col("_rows") < F.col("_quota")))
        .select("_stratum", "_bucket", (F.col("_quota") - F.col("_upto") + F.col("_rows")).alias("_left"))
    )
    in_edge = tickets.withColumn("_bucket", bucket).join(materialise(edges, "edges"), ["_stratum", "_bucket"])
    place = F.row_number().over(Window.partitionBy("_stratum").orderBy("_ticket"))
    last_in = (
        in_edge.withColumn("_place", place).filter(F.col("_place") == F.col("_left"))
        .select("_stratum", F.col("_ticket").alias("_last"))
    )
    # a quota of 0, or a stratum smaller than its quota, has no edge
    sizes = histogram.groupBy("_stratum").agg(F.sum("_rows").alias("stratum_size"))
    limits = sizes.join(last_in, "_stratum", "left").select(
        "_stratum", "_last", (F.col("stratum_size") < quota).alias("_all")
    )
    # one row per stratum, stored so that the planner sees how small it is and moves no ticket
    return materialise(limits, "limits")


def take_by_draw(df: DataFrame, key: str, stratum: Column, quota: Column, seed: int, flag: str) -> DataFrame:
    """Mark, in each stratum, exactly the `quota` rows with the smallest draws.

    `quota` is an expression over `stratum_size`.
    """
    limits = _limits(df, key, stratum, quota, seed)
    inside = F.col("_all") | F.coalesce(_ticket(key, seed) <= F.col("_last"), F.lit(False))
    return df.withColumn("_stratum", stratum).join(limits, "_stratum").withColumn(flag, inside).drop("_stratum", "_last", "_all")


def capped_sample(df: DataFrame, key: str, cap: int = 200_000, seed: int = 42) -> DataFrame:
    """Uniform sample of exactly `cap` rows, or everything when there are fewer."""
    limit = _limits(df, key, F.lit(0), F.lit(cap), seed).first()  # one row
    if limit is None or limit["_all"]:
        return df
    return df.filter(_ticket(key, seed) <= limit["_last"]) if limit["_last"] is not None else df.limit(0)


def stratified_split(df: DataFrame, key: str, label: str, test_fraction: float = 0.2, seed: int = 42) -> DataFrame:
    """Add `is_test`, true for the given share of every label, rounded to whole rows."""
    quota = F.round(F.col("stratum_size") * F.lit(test_fraction))
    return take_by_draw(df, key, F.col(label), quota, seed, "is_test")
