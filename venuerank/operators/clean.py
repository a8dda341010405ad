"""Raw records to clean venues and enriched reviews."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from venuerank import schemas
from venuerank.functions.geo import with_grid_cell
from venuerank.functions.rows import complete_rows
from venuerank.functions.scoring import recency_weight
from venuerank.functions.text import has_any_tag
from venuerank.functions.vocabulary import FOOD_AND_DRINK_TAGS
from venuerank.operators.metro import METRO_RADIUS_KM, assign_metros, build_metro_map, city_anchors


def open_food_businesses(businesses: DataFrame) -> DataFrame:
    """Open, located food and drink venues with a tidy city, state and `city_key`."""
    return (
        complete_rows(businesses.select(*schemas.BUSINESS_COLUMNS), ["business_id", "latitude", "longitude"])
        .filter(F.col("is_open") == 1)
        .filter(has_any_tag(F.col("categories"), FOOD_AND_DRINK_TAGS))
        .withColumn("city", F.initcap(F.trim("city")))
        .withColumn("state", F.upper(F.trim("state")))
        .withColumn("city_key", F.concat("city", F.lit("_"), "state"))
    )


def clean_businesses(businesses: DataFrame, radius_km: float = METRO_RADIUS_KM) -> DataFrame:
    tidy = open_food_businesses(businesses)
    return assign_metros(tidy, build_metro_map(city_anchors(tidy), radius_km))


def clean_reviews(reviews: DataFrame) -> DataFrame:
    return complete_rows(reviews.select(*schemas.REVIEW_COLUMNS), schemas.REVIEW_COLUMNS)


def build_enriched(reviews: DataFrame, businesses: DataFrame, as_of: datetime.date | str) -> DataFrame:
    """Clean reviews with the attributes, recency weight and grid cell of their venue.

    The cell is computed once per venue, before the join. A venue with a large share of the
    reviews is split by AQE's skew join; nothing downstream of the join needs its partitioning.
    """
    return reviews.join(with_grid_cell(businesses), "business_id").withColumn(
        "recency_weight", recency_weight(F.col("date"), as_of)
    )
