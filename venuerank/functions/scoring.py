"""Column expressions for weights, scores, labels and display classes."""

from __future__ import annotations

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

DATE_FORMAT = "yyyy-MM-dd HH:mm:ss"
PRIOR_REVIEWS = 30
HIGH_BAND, MEDIUM_BAND = 0.7, 0.4

# Display colours, hottest first.
HEAT_COLOURS = ("#c62828", "#ef6c00", "#2e7d32")
CHART_COLOURS = ("#c62828", "#e65100", "#2e7d32")
PIN_COLOURS = ("green", "orange", "lightgray")


def review_day(date: Column) -> Column:
    """The day of a review; null when its date is unreadable."""
    return F.try_to_timestamp(date, F.lit(DATE_FORMAT)).cast("date")


def recency_weight(date: Column, as_of: datetime.date | str) -> Column:
    """1 / (1 + age in years); null when the date is unreadable or the formula has its pole."""
    return day_weight(review_day(date), as_of)


def day_weight(day: Column, as_of: datetime.date | str) -> Column:
    age = F.datediff(F.lit(str(as_of)).cast("date"), day).cast("double")
    return F.try_divide(F.lit(1.0), 1 + age / 365.0)


def popularity(avg_rating: Column, review_count: Column, recency: Column) -> Column:
    return 0.4 * avg_rating + 0.4 * F.ln(review_count + 1) + 0.2 * recency


def score_order(score: str | Column) -> Column:
    """Descending sort key for a computed score.

    Sums of doubles depend on the order in which tasks deliver, so ties must not be decided
    by the last bits; callers add a unique key behind this one.
    """
    column = F.col(score) if isinstance(score, str) else score
    return F.round(column, 9).desc_nulls_last()


def is_positive(stars: Column) -> Column:
    return stars >= 4


def is_negative(stars: Column) -> Column:
    return stars <= 2


def star_label(stars: Column) -> Column:
    return (
        F.when(is_positive(stars), F.lit("positive"))
        .when(is_negative(stars), F.lit("negative"))
        .otherwise(F.lit("neutral"))
    )


def bayesian_score(positive: Column, negative: Column, prior_rate: Column, prior: int = PRIOR_REVIEWS) -> Column:
    """Share of positive reviews on a 0-10 scale, shrunk towards `prior_rate`."""
    return (positive + prior * prior_rate) / (positive + negative + prior) * 10


def half_even(value: Column, digits: int) -> Column:
    """Round half to even on the decimal value, not on its binary neighbour.

    Twelve places are kept first: enough that no value is moved onto a tie, few enough that the
    last bits of a sum don't move a tie off itself.
    """
    return F.bround(value.cast("decimal(38,12)"), digits).cast("double")


def min_max(value: Column, low: Column, high: Column, floor: float = 1e-6) -> Column:
    return (value - low) / F.greatest(high - low, F.lit(floor))


def banded(value: Column, names: tuple[str, str, str], high: float = HIGH_BAND, medium: float = MEDIUM_BAND) -> Column:
    return F.when(value >= high, F.lit(names[0])).when(value >= medium, F.lit(names[1])).otherwise(F.lit(names[2]))


def full_stars(rating: Column) -> Column:
    return F.least(half_even(rating, 0).cast("int"), F.lit(5))


def percent_of(value: Column, whole: float) -> Column:
    """Whole percent, truncated and capped at 100."""
    return F.least((F.least(value, F.lit(float(whole))) / whole * 100).cast("int"), F.lit(100))


def status(value: Column, passed: Column) -> Column:
    return F.when(value.isNull(), F.lit(None)).when(passed, F.lit("PASS")).otherwise(F.lit("FAIL"))
