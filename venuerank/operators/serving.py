"""Queries over the gold tables: lists, recommendations and map layers.

Each works for all metros, users or requests at once; filter the inputs for a single one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from venuerank.functions.geo import cell_bounds, valid_coordinate
from venuerank.functions.scoring import (
    HEAT_COLOURS, PIN_COLOURS, banded, full_stars, min_max, percent_of, score_order,
)
from venuerank.functions.text import contains_ignoring_case, tags
from venuerank.functions.vocabulary import CUISINE_TAGS
from venuerank.operators.neighborhoods import add_neighborhood_labels
from venuerank.operators.ranking import top_per_group

PINS = 50
RECOMMENDATIONS_SHOWN = 20
ALL_CUISINES = "All"


def in_metro(table: DataFrame, metro: str) -> DataFrame:
    return table.filter(F.col("metro_area") == metro)


def in_city(table: DataFrame, city: str) -> DataFrame:
    return table.filter(F.col("city") == city)


def metros(business_scores: DataFrame) -> DataFrame:
    return business_scores.select("metro_area").distinct().orderBy("metro_area")


def cities(business_scores: DataFrame) -> DataFrame:
    return business_scores.select("city").distinct().orderBy("city")


def serves(cuisine: str | None) -> Column:
    """Case-insensitive substring of the categories; no cuisine or "All" lets everything pass."""
    if not cuisine or cuisine == ALL_CUISINES:
        return F.lit(True)
    return F.coalesce(contains_ignoring_case(F.col("categories"), cuisine), F.lit(False))


def serves_any(cuisines: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [serves(c) for c in cuisines], F.lit(False))


def best_first() -> list[Column]:
    return [score_order("popularity_score"), F.col("business_id").asc()]


def businesses_by_cuisine(business_scores: DataFrame, cuisine: str | None = None) -> DataFrame:
    return business_scores.filter(serves(cuisine)).orderBy(F.col("metro_area"), *best_first())


def cuisine_tags_by_metro(business_scores: DataFrame) -> DataFrame:
    """Cuisine tags in use, in their original spelling."""
    return (
        business_scores.select("metro_area", F.explode(tags(F.col("categories"))).alias("cuisine"))
        .filter(F.lower("cuisine").isin(CUISINE_TAGS))
        .distinct()
        .orderBy("metro_area", "cuisine")
    )


def metro_summary(business_scores: DataFrame, grid: DataFrame, cuisine: str | None = None) -> DataFrame:
    """Neighbourhoods, venues and mean rating of each metro, venues filtered by cuisine."""
    cells = grid.groupBy("metro_area").agg(F.count(F.lit(1)).alias("neighborhoods"))
    venues = (
        business_scores.filter(serves(cuisine)).groupBy("metro_area")
        .agg(F.count(F.lit(1)).alias("restaurants"), F.avg("avg_rating").alias("mean_rating"))
    )
    return cells.join(venues, "metro_area", "left").withColumn("restaurants", F.coalesce("restaurants", F.lit(0)))


def display_table(business_scores: DataFrame) -> DataFrame:
    shown = {
        "name": "Name", "categories": "Cuisine", "avg_rating": "Avg Rating",
        "review_count": "Reviews", "popularity_score": "Score",
    }
    return business_scores.select(*[F.col(column).alias(title) for column, title in shown.items()])


# --- recommendations -------------------------------------------------------------------------

_VENUE = [
    "business_id", "name", "city", "metro_area", "categories",
    "avg_rating", "review_count", "latitude", "longitude",
]


def recommendations_for(
    requests: DataFrame, recommendations: DataFrame, business_scores: DataFrame, limit: int = RECOMMENDATIONS_SHOWN
) -> DataFrame:
    """Answers to `requests(user_id, requested_metro)`.

    A user's venues in the requested metro; when there are none, the user's venues anywhere,
    which `city_filtered` tells apart.
    """
    # a user has at most as many rows as the recommender ranks, ten by default
    request = Window.partitionBy("user_id", "requested_metro")
    here = F.coalesce(F.col("metro_area") == F.col("requested_metro"), F.lit(False))
    return (
        requests.select("user_id", "requested_metro").distinct()
        .join(recommendations, "user_id")
        .join(business_scores.select(*_VENUE), "business_id")
        .withColumn("city_filtered", F.max(here).over(request))
        .filter(here | ~F.col("city_filtered"))
        .withColumn("_place", F.row_number().over(request.orderBy("rank", "business_id")))
        .filter(F.col("_place") <= limit)
        .select("user_id", "requested_metro", "city_filtered", "rank", "predicted_rating", *_VENUE)
    )


def recommendation_details(recommendations: DataFrame, business_scores: DataFrame) -> DataFrame:
    """Recommendations with venue details, nulls for venues without scores."""
    details = business_scores.select("business_id", "name", "city", "avg_rating", "review_count")
    return recommendations.join(details, "business_id", "left")


def taste_matches(
    recommendations: DataFrame, business_scores: DataFrame, metro: str, cuisines: list[str]
) -> DataFrame:
    """Per user: how many recommended venues of the metro serve one of the cuisines."""
    wanted = in_metro(business_scores, metro).filter(serves_any(cuisines)).select("business_id")
    return recommendations.join(wanted, "business_id").groupBy("user_id").agg(
        F.count(F.lit(1)).alias("matches"), F.avg("predicted_rating").alias("avg_pred")
    )


def find_proxy_user(
    recommendations: DataFrame, business_scores: DataFrame, metro: str, cuisines: list[str]
) -> DataFrame:
    """The user whose recommendations fit the cuisines best; no row when nobody's do."""
    order = [F.desc("matches"), score_order("avg_pred"), F.asc("user_id")]
    return taste_matches(recommendations, business_scores, metro, cuisines).orderBy(*order).limit(1)


def recommendation_cards(shown: DataFrame) -> DataFrame:
    capped = F.least(F.col("predicted_rating").cast("double"), F.lit(5.0))
    return shown.select(
        "user_id", "rank", "name", "categories", "city", "review_count",
        full_stars(F.col("avg_rating")).alias("full_stars"),
        (5 - full_stars(F.col("avg_rating"))).alias("empty_stars"),
        capped.alias("predicted"),
        percent_of(F.col("predicted_rating").cast("double"), 5).alias("match_pct"),
    )


def search_cards(results: DataFrame) -> DataFrame:
    rating = F.coalesce("avg_rating", F.lit(0.0))
    return results.select(
        "query_id", "position", "name", "city", "review_count",
        full_stars(rating).alias("full_stars"),
        (5 - full_stars(rating)).alias("empty_stars"),
        percent_of(F.col("final_score"), 1).alias("match_pct"),
    )


# --- map layers ------------------------------------------------------------------------------

def _ranges(table: DataFrame, value: Column) -> DataFrame:
    return table.groupBy("metro_area").agg(F.min(value).alias("_low"), F.max(value).alias("_high"))


def heat_points(grid: DataFrame) -> DataFrame:
    """Centre, weight in 0..1 within the metro, and colour of every cell."""
    ranges = _ranges(grid, F.col("avg_popularity")).withColumn(
        "_high", F.when(F.col("_high") == 0, F.lit(1.0)).otherwise(F.col("_high"))
    )
    weight = min_max(F.col("avg_popularity"), F.col("_low"), F.col("_high"))
    return grid.join(ranges, "metro_area").withColumn("weight", weight).select(
        "metro_area", "grid_cell", "center_lat", "center_lng", "weight",
        banded(F.col("weight"), HEAT_COLOURS).alias("colour"),
    )


def business_pins(business_scores: DataFrame, cuisine: str | None = None, pins: int = PINS) -> DataFrame:
    """Each metro's most popular venues, coloured by their standing among those shown."""
    score = F.coalesce("popularity_score", F.lit(0.0))
    shown = top_per_group(
        business_scores.filter(serves(cuisine)), ["metro_area"], best_first(), pins, ["business_id"], "position"
    )
    metro = Window.partitionBy("metro_area")  # `pins` rows
    norm = min_max(score, F.min(score).over(metro), F.max(score).over(metro))
    return (
        shown.withColumn("norm", norm)
        .filter(valid_coordinate(F.col("latitude")) & valid_coordinate(F.col("longitude")))
        .select("metro_area", "position", "business_id", "name", "categories", "latitude", "longitude",
                "avg_rating", "review_count", score.alias("popularity_score"),
                banded(F.col("norm"), PIN_COLOURS).alias("pin_class"))
    )


def cell_rectangles(grid: DataFrame, places: DataFrame | None = None) -> DataFrame:
    """Named rectangle of every cell with what its popup shows."""
    bounds = cell_bounds(F.col("grid_cell"), F.col("center_lat"), F.col("center_lng"))
    return add_neighborhood_labels(grid, places).select(
        "metro_area", "grid_cell", "neighborhood", *[edge.alias(name) for name, edge in bounds.items()],
        "top_cuisine", "avg_popularity", "restaurant_count",
    )


def recommendation_pins(shown: DataFrame) -> DataFrame:
    return shown.filter(valid_coordinate(F.col("latitude")) & valid_coordinate(F.col("longitude"))).select(
        "user_id", "rank", "name", "categories", "latitude", "longitude", "avg_rating", "review_count",
        "predicted_rating", full_stars(F.col("avg_rating")).alias("full_stars"),
    )
