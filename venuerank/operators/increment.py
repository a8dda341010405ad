"""Venue totals that grow with new reviews instead of being counted anew.

The state has one row for each venue and day: how many reviews, their stars, and how many were good or bad.
That is all the totals need, at any date: recency is worked out for each day, not each review, so
a later `as_of` ages the sums without reading a review again. A watermark says up to which load the state
goes; loads at or below it are left out, so a load that is given twice counts once.
"""

from __future__ import annotations

import datetime
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from venuerank.functions.scoring import day_weight, is_negative, is_positive, review_day
from venuerank.session import materialise

SUMS = ["reviews", "star_sum", "positive", "negative"]


class State(NamedTuple):
    days: DataFrame  # business_id, day, reviews, star_sum, positive, negative
    through: int     # the last load it holds


def daily_totals(reviews: DataFrame) -> DataFrame:
    """Sums by venue and day; reviews of unreadable dates are a day of their own, null."""
    return reviews.groupBy("business_id", review_day(F.col("date")).alias("day")).agg(
        F.count(F.lit(1)).alias("reviews"), F.sum(F.col("stars").cast("double")).alias("star_sum"),
        F.count_if(is_positive(F.col("stars"))).alias("positive"), F.count_if(is_negative(F.col("stars"))).alias("negative"),
    )


def advance(state: State | None, reviews: DataFrame, load: str = "load") -> State:
    """The state with the loads of clean `reviews` above its watermark; stored."""
    through = -1 if state is None else state.through
    new = reviews.filter(F.col(load) > through)
    last = new.agg(F.max(load)).first()[0]
    if last is None:
        return state or State(materialise(daily_totals(new), "daily-totals"), through)
    days = daily_totals(new)
    if state is not None:
        days = state.days.unionByName(days).groupBy("business_id", "day").agg(*[F.sum(c).alias(c) for c in SUMS])
    return State(materialise(days, "daily-totals"), int(last))


def totals(state: State, as_of: datetime.date | str) -> DataFrame:
    """What `scores.review_totals` gives for all reviews of the state, at `as_of`."""
    aged = state.days.withColumn("recency", F.col("reviews") * day_weight(F.col("day"), as_of))
    return aged.groupBy("business_id").agg(
        F.sum("reviews").alias("reviews"), (F.sum("star_sum") / F.sum("reviews")).alias("avg_rating"), F.sum("recency").alias("recency_sum"),
        F.sum("positive").alias("positive"), F.sum("negative").alias("negative"),
    )
