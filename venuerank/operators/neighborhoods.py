"""Readable names for grid cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from venuerank.functions.geo import compass_label
from venuerank.operators.ranking import top_per_group

NAMED_CELLS = 10

# Address parts that can name a neighbourhood, best first.
PLACE_PARTS = [
    "neighbourhood", "suburb", "quarter", "city_district", "hamlet", "locality", "town", "village", "municipality",
]


def place_name(places: DataFrame) -> Column:
    """First address part that is filled in."""
    parts = [F.when(F.col(p) != "", F.col(p)) for p in PLACE_PARTS if p in places.columns]
    return F.coalesce(*parts)


def metro_centres(cells: DataFrame) -> DataFrame:
    """Unweighted mean of the cell centres of each metro."""
    return cells.groupBy("metro_area").agg(
        F.avg("center_lat").alias("city_lat"), F.avg("center_lng").alias("city_lng")
    )


def largest_cells(cells: DataFrame, n: int = NAMED_CELLS) -> DataFrame:
    """`metro_area, grid_cell` of each metro's largest cells by venue count, else by popularity."""
    size = next((c for c in ("restaurant_count", "avg_popularity") if c in cells.columns), None)
    if size is None:
        return cells.select("metro_area", "grid_cell").limit(0)
    order = [F.col(size).desc_nulls_last(), F.col("grid_cell").asc()]
    return top_per_group(cells, ["metro_area"], order, n, ["grid_cell"], "_place").select("metro_area", "grid_cell")


def add_neighborhood_labels(cells: DataFrame, places: DataFrame | None = None) -> DataFrame:
    """Add `neighborhood`: a compass label from the metro's centre, numbered where it repeats.

    `places(grid_cell, <address parts>)` may name the largest cells of each metro instead.
    Frames without `grid_cell` come back unchanged; rows without a metro are left out.
    """
    if "grid_cell" not in cells.columns:
        return cells
    label = compass_label(F.col("grid_cell"), F.col("city_lat"), F.col("city_lng"))
    labelled = cells.join(metro_centres(cells), "metro_area").withColumn("_label", label)
    if places is not None:
        named = places.select("grid_cell", place_name(places).alias("_place"))
        chosen = largest_cells(cells).join(named, "grid_cell")
        labelled = labelled.join(chosen, ["metro_area", "grid_cell"], "left").withColumn(
            "_label", F.coalesce("_place", "_label")
        ).drop("_place")
    # cells, not venues: at most one row per 0.1-degree cell of the globe and metro
    same = Window.partitionBy("metro_area", "_label")
    number = F.row_number().over(same.orderBy("grid_cell"))
    repeated = F.count(F.lit(1)).over(same) > 1
    return labelled.withColumn(
        "neighborhood", F.when(repeated, F.concat_ws(" ", "_label", number)).otherwise(F.col("_label"))
    ).drop("_label", "city_lat", "city_lng")
