"""Sentiment of grid cells from star labels, and diner satisfaction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from venuerank import schemas
from venuerank.functions.geo import with_grid_cell
from venuerank.functions.scoring import (
    CHART_COLOURS, banded, bayesian_score, half_even, is_negative, is_positive, score_order, star_label,
)



def _scored(counts: DataFrame) -> DataFrame:
    judged = F.col("positive_count") + F.col("negative_count")
    return (
        counts.filter(judged > 0)
        .withColumn("sentiment_score", F.col("positive_count") / judged)
        .select(*schemas.SENTIMENT_COLUMNS)
    )


def compute_grid_sentiment(enriched: DataFrame) -> DataFrame:
    """Share of positive reviews per cell; cells with neutral reviews only are left out."""
    return _scored(
        enriched.groupBy("grid_cell").agg(
            F.count_if(is_positive(F.col("stars"))).alias("positive_count"),
            F.count_if(is_negative(F.col("stars"))).alias("negative_count"),
        )
    )


def grid_sentiment_by_pivot(enriched: DataFrame) -> DataFrame:
    """The same table by pivoting the star label."""
    counts = (
        enriched.withColumn("label", star_label(F.col("stars")))
        .groupBy("grid_cell").pivot("label", ["positive", "negative"]).count()
        .na.fill(0, ["positive", "negative"])
    )
    return _scored(counts.withColumnsRenamed({"positive": "positive_count", "negative": "negative_count"}))


def sentiment_from_totals(totals: DataFrame, businesses: DataFrame) -> DataFrame:
    """The same table from per-venue totals, see `scores.review_totals`."""
    venues = with_grid_cell(businesses).select("business_id", "grid_cell")
    return _scored(
        venues.join(totals, "business_id").groupBy("grid_cell").agg(
            F.sum("positive").alias("positive_count"), F.sum("negative").alias("negative_count")
        )
    )


def cell_sentiment(grid: DataFrame, sentiment: DataFrame) -> DataFrame:
    """Every cell of every metro with its sentiment, zeros where there is none.

    Joined on the cell alone: metros that share a cell share its sentiment.
    """
    measures = [F.coalesce(F.col(c), F.lit(0)).alias(c) for c in schemas.SENTIMENT_COLUMNS[1:]]
    return grid.select("metro_area", "grid_cell", "center_lat", "center_lng", "restaurant_count").join(
        sentiment, "grid_cell", "left"
    ).select("metro_area", "grid_cell", "center_lat", "center_lng", "restaurant_count", *measures)


def _prior_rate() -> Column:
    judged = F.sum(F.col("positive_count") + F.col("negative_count"))
    return F.coalesce(F.try_divide(F.sum("positive_count"), judged), F.lit(0.5))


def satisfaction_ranking(grid: DataFrame, sentiment: DataFrame, labels: DataFrame) -> DataFrame:
    """Neighbourhoods of each metro by satisfaction, shrunk towards the metro's own rate."""
    cells = cell_sentiment(grid, sentiment)
    rates = cells.groupBy("metro_area").agg(_prior_rate().alias("metro_rate"))
    names = labels.select("metro_area", "grid_cell", "neighborhood")
    # cells, not reviews: at most one row per 0.1-degree cell of the globe and metro
    best_first = Window.partitionBy("metro_area").orderBy(F.desc("satisfaction"), "grid_cell")
    score = bayesian_score(F.col("positive_count"), F.col("negative_count"), F.col("metro_rate"))
    return (
        cells.join(rates, "metro_area").join(names, ["metro_area", "grid_cell"], "left")
        .withColumn("satisfaction", half_even(score, 1))
        .withColumn("position", F.row_number().over(best_first))
        .select("metro_area", "position", "grid_cell", "neighborhood", "satisfaction",
                "positive_count", "negative_count", "restaurant_count")
    )


def bayesian_cells(grid: DataFrame, sentiment: DataFrame) -> DataFrame:
    """Raw and shrunk score of every cell with sentiment, on the rate over all of them."""
    located = sentiment.join(grid.select("grid_cell", "metro_area", "restaurant_count"), "grid_cell", "left")
    overall = located.select(
        F.try_divide(F.sum("positive_count"), F.sum(F.col("positive_count") + F.col("negative_count"))).alias("rate")
    ).scalar()
    judged = F.greatest(F.col("positive_count") + F.col("negative_count"), F.lit(1))
    return (
        located.withColumn("global_rate", overall)
        .withColumn("raw_score", F.col("positive_count") / judged)
        .withColumn(
            "bayesian_score", bayesian_score(F.col("positive_count"), F.col("negative_count"), F.col("global_rate"))
        )
        .withColumn("band", banded(F.col("bayesian_score"), CHART_COLOURS, 8, 6))
    )


def sentiment_chart(scored_cells: DataFrame) -> DataFrame:
    """Raw and shrunk score of each metro's cells on one 0-10 scale, best first."""
    return scored_cells.select(
        "metro_area", F.col("grid_cell").alias("cell"), (F.col("raw_score") * 10).alias("raw"),
        "bayesian_score", (F.col("global_rate") * 10).alias("city_average"), "band",
    ).orderBy("metro_area", score_order("bayesian_score"), "cell")


def spatial_coverage(grid: DataFrame, scored_cells: DataFrame) -> DataFrame:
    """Cells with their popularity and, where known, their shrunk sentiment."""
    scores = scored_cells.select("grid_cell", "metro_area", "bayesian_score")
    return grid.join(scores, ["grid_cell", "metro_area"], "left").select(
        "metro_area", "grid_cell", "center_lat", "center_lng", "avg_popularity", "restaurant_count", "bayesian_score"
    )
