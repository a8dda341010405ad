"""Ranking that never sorts a whole table, or one hot group, in a single task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from venuerank.session import materialise

_INDEX_BITS = 33  # monotonically_increasing_id keeps the row index in the low 33 bits


def top_per_group(
    df: DataFrame,
    keys: list[str],
    order: list[Column],
    k: int,
    spread_by: list[str],
    rank_name: str = "rank",
    slices: int = 32,
) -> DataFrame:
    """First `k` rows of each group by `order`, numbered from 1.

    The winners of `slices` hash slices of each group are found first and only those meet in
    one task, so a group of any size costs a task at most ``slices * k`` rows at the end.
    `order` must be a total order for the result to repeat.
    """
    within_slice = Window.partitionBy(*keys, "_slice").orderBy(*order)
    within_group = Window.partitionBy(*keys).orderBy(*order)
    winners = (
        df.withColumn("_slice", F.pmod(F.xxhash64(*spread_by), F.lit(slices)).cast("int"))
        .withColumn("_place", F.row_number().over(within_slice))
        .filter(F.col("_place") <= k)
        .drop("_place", "_slice")
    )
    return winners.withColumn(rank_name, F.row_number().over(within_group)).filter(F.col(rank_name) <= k)


def ordered_position(df: DataFrame, order: list[Column], name: str = "position") -> DataFrame:
    """0-based position of every row in one global order.

    A range-partitioned sort is written out once with each row's index inside its sort
    partition; adding the sizes of the partitions before gives the position.
    """
    indexed = df.orderBy(*order).withColumn("_mark", F.monotonically_increasing_id())
    stored = (
        materialise(indexed, "sorted")
        .withColumn("_part", F.shiftright("_mark", _INDEX_BITS).cast("int"))
        .withColumn("_index", F.col("_mark").bitwiseAND(F.lit((1 << _INDEX_BITS) - 1)))
        .drop("_mark")
    )
    sizes = stored.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    # one row per sort partition, so never more than spark.sql.shuffle.partitions rows
    return (
        stored.join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + F.col("_index"))
        .drop("_part", "_index", "_start")
    )


def position_within(df: DataFrame, group: str, order: list[Column], name: str = "position") -> DataFrame:
    """0-based position inside each group, with the group's size as ``group_size``."""
    placed = ordered_position(df, [F.col(group).asc_nulls_first(), *order], "_global")
    spans = placed.groupBy(F.col(group).alias("_group")).agg(
        F.min("_global").alias("_first"), F.count(F.lit(1)).alias("group_size")
    )
    return (
        placed.join(materialise(spans, "spans"), F.col(group).eqNullSafe(F.col("_group")))
        .withColumn(name, F.col("_global") - F.col("_first"))
        .drop("_global", "_first", "_group")
    )


def running_total(df: DataFrame, order: list[Column], amount: str, name: str) -> DataFrame:
    """Adds the sum of `amount` over all rows before each in one global order.

    Rows are range-sorted and stored with their sort partition; sums run within a partition and
    start from the sums of the partitions before it.
    """
    indexed = df.orderBy(*order).withColumn("_mark", F.monotonically_increasing_id())
    stored = materialise(indexed, "running").withColumn("_part", F.shiftright("_mark", _INDEX_BITS).cast("int"))
    sums = stored.groupBy("_part").agg(F.sum(amount).alias("_sum"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_part").orderBy("_mark").rowsBetween(Window.unboundedPreceding, -1)
    # one row per sort partition, so never more than spark.sql.shuffle.partitions rows
    return (
        stored.withColumn("_inside", F.coalesce(F.sum(amount).over(inside), F.lit(0)))
        .join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + F.col("_inside"))
        .drop("_part", "_mark", "_start", "_inside")
    )
