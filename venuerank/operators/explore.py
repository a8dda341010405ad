"""Exploratory statistics over raw records and venue scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from venuerank.functions.scoring import CHART_COLOURS, banded, half_even, min_max, score_order
from venuerank.operators.ranking import ordered_position, running_total, top_per_group
from venuerank.session import materialise

BINS = 20
SCORES = ["avg_rating", "popularity_score"]
MEASURES = ["avg_rating", "review_count", "recency_score", "popularity_score"]


def frequency(df: DataFrame, value: Column, name: str) -> DataFrame:
    return df.groupBy(value.alias(name)).agg(F.count(F.lit(1)).alias("rows"))


def star_frequency(reviews: DataFrame) -> DataFrame:
    return frequency(reviews.filter(F.col("stars").isNotNull()), F.col("stars"), "stars")


def city_frequency(businesses: DataFrame) -> DataFrame:
    return frequency(businesses.filter(F.col("city").isNotNull()), F.col("city"), "city")


def open_frequency(businesses: DataFrame) -> DataFrame:
    state = F.when(F.col("is_open") == 1, "Open").when(F.col("is_open") == 0, "Closed")
    return frequency(businesses.filter(state.isNotNull()), state, "state")


def _long(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row per metric and value."""
    pairs = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in columns])
    return df.select(F.inline(pairs)).filter(F.col("value").isNotNull())


def score_histogram(business_scores: DataFrame, columns: list[str] = SCORES, bins: int = BINS) -> DataFrame:
    """Equal-width bins of each score, empty ones included, with the score's mean."""
    values = _long(business_scores, columns)
    spans = values.groupBy("metric").agg(
        F.min("value").alias("low"), F.max("value").alias("high"), F.avg("value").alias("mean")
    )
    share = min_max(F.col("value"), F.col("low"), F.col("high"), 1e-12)
    bin_of = F.least(F.floor(share * bins), F.lit(bins - 1)).cast("int")
    # one row per column name
    counts = values.join(F.broadcast(spans), "metric").groupBy("metric", bin_of.alias("bin")).agg(F.count(F.lit(1)).alias("rows"))
    width = (F.col("high") - F.col("low")) / bins
    return (
        spans.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
        .join(counts, ["metric", "bin"], "left")
        .select("metric", "bin", (F.col("low") + width * F.col("bin")).alias("bin_start"),
                F.coalesce("rows", F.lit(0)).alias("rows"), "mean")
    )


def score_summary(business_scores: DataFrame, columns: list[str] = MEASURES) -> DataFrame:
    """Count, mean, deviation, extremes and exact quartiles, to three digits.

    Equal values are counted together first, so a value that many venues share is one row of the
    distributed sort; quartiles interpolate between neighbours found by the running counts.
    """
    values = _long(business_scores, columns)
    plain = values.groupBy("metric").agg(
        F.count(F.lit(1)).alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"),
    )
    counted = values.groupBy("metric", "value").agg(F.count(F.lit(1)).alias("rows"))
    placed = running_total(counted, [F.asc("metric"), F.asc("value")], "rows", "before")
    starts = placed.groupBy("metric").agg(F.min("before").alias("first"), F.sum("rows").alias("size"))
    within = placed.join(materialise(starts, "metric-sizes"), "metric").withColumn("before", F.col("before") - F.col("first"))

    def at(position: Column) -> Column:
        there = (F.col("before") <= position) & (position < F.col("before") + F.col("rows"))
        return F.max(F.when(there, F.col("value")))

    def quartile(p: float) -> Column:
        place = (F.col("size") - 1) * F.lit(p)
        low, high = at(F.floor(place)), at(F.ceil(place))
        return low + (high - low) * F.max(place - F.floor(place))

    quartiles = within.groupBy("metric").agg(*[quartile(p).alias(n) for n, p in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75))])
    return plain.join(quartiles, "metric").select(
        "metric", "count", *[half_even(F.col(c), 3).alias(c) for c in ("mean", "std", "min", "p25", "p50", "p75", "max")]
    )


def rank_shift(business_scores: DataFrame) -> DataFrame:
    """0-based places by plain rating and by popularity, and how far the second moves a venue.

    A negative shift is a move up.
    """
    shown = business_scores.select("business_id", "name", "avg_rating", "review_count", "popularity_score")

    def places(score: str, name: str) -> DataFrame:
        # id and score alone are sorted
        ranked = ordered_position(business_scores.select("business_id", score), [score_order(score), F.asc("business_id")], name)
        return ranked.select("business_id", name)

    return (
        shown.join(places("avg_rating", "rank_raw"), "business_id").join(places("popularity_score", "rank_pop"), "business_id")
        .withColumn("rank_shift", F.col("rank_pop") - F.col("rank_raw"))
    )


def rank_movers(shifts: DataFrame, n: int = 10) -> DataFrame:
    """The `n` venues that move up most and the `n` that move down most."""
    up = shifts.orderBy(F.asc("rank_shift"), F.asc("business_id")).limit(n).withColumn("direction", F.lit("up"))
    down = shifts.orderBy(F.desc("rank_shift"), F.asc("business_id")).limit(n).withColumn("direction", F.lit("down"))
    return up.unionByName(down)


def top_by_city(business_scores: DataFrame, n: int = 10) -> DataFrame:
    """Each city's most popular venues with a colour by their standing among them."""
    order = [score_order("popularity_score"), F.asc("business_id")]
    top = top_per_group(business_scores, ["city"], order, n, ["business_id"], "position")
    city = Window.partitionBy("city")  # `n` rows
    score = F.col("popularity_score")
    norm = min_max(score, F.min(score).over(city), F.max(score).over(city), 1e-9)
    return top.withColumn("norm", norm).select(
        "city", "position", "business_id", "name", "popularity_score",
        banded(F.col("norm"), CHART_COLOURS).alias("colour"),
    )
