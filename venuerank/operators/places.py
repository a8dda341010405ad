"""Nearest places on the globe, by rings of grid cells that grow until nothing outside can be nearer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venuerank.functions.geo import EARTH_RADIUS_KM, haversine_km
from venuerank.operators.ranking import top_per_group
from venuerank.session import materialise

LEVELS = 10  # cells of 360 / 2^10 degrees first, then twice as wide each time, up to the whole globe


def _row(lat: Column, degrees: float) -> Column:
    return F.floor((lat + 90) / degrees).cast("int")


def _column(lng: Column, degrees: float) -> Column:
    return F.pmod(F.floor((lng + 180) / degrees).cast("int"), F.lit(round(360 / degrees)))


def _outside_km(lat: Column, degrees: float) -> Column:
    """How far at least anything is that lies no neighbouring cell: across a parallel, or across a meridian."""
    across_parallel = F.lit(EARTH_RADIUS_KM) * F.radians(F.lit(degrees))
    if round(360 / degrees) <= 3:
        return across_parallel  # the neighbours go all the way round
    step = F.sin(F.radians(F.lit(min(degrees, 90.0))))
    return F.least(across_parallel, F.lit(EARTH_RADIUS_KM) * F.asin(F.cos(F.radians(lat)) * step))


def nearest_places(points: DataFrame, places: DataFrame, key: list[str], k: int = 1) -> DataFrame:
    """`key, place, distance_km, rank` of the `k` nearest of `places(place, lat, lng)` to each of `points(key, lat, lng)`.

    A point meets the places of its own cell and the eight around it; where its k-th is nearer than
    anything outside can be, it is done, else it goes on with cells twice as wide. Cells join on
    their numbers, and columns go round the globe, so the date line is no border. Ties go to the
    first place in order. Points or places without coordinates have no part.
    """
    located = lambda df: df.filter(F.col("lat").isNotNull() & F.col("lng").isNotNull())
    left = materialise(located(points.select(*key, "lat", "lng")).distinct(), "points")
    known = materialise(located(places.select("place", F.col("lat").alias("lat"), F.col("lng").alias("lng"))).distinct(), "places")
    done: list[DataFrame] = []
    order = [F.round("distance_km", 9).asc(), F.col("place").asc()]
    for level in range(LEVELS + 1):
        degrees = 360 / 2 ** (LEVELS - level)
        columns = round(360 / degrees)
        cells = known.select("place", F.col("lat").alias("p_lat"), F.col("lng").alias("p_lng"), _row(F.col("lat"), degrees).alias("row"), _column(F.col("lng"), degrees).alias("column"))
        around = F.array_distinct(F.transform(F.array(*[F.lit(d) for d in (-1, 0, 1)]), lambda d: F.pmod(_column(F.col("lng"), degrees) + d, F.lit(columns))))
        near = (
            left.withColumn("row", F.explode(F.transform(F.array(*[F.lit(d) for d in (-1, 0, 1)]), lambda d: _row(F.col("lat"), degrees) + d)))
            .withColumn("column", F.explode(around))
            .join(cells, ["row", "column"])
            .withColumn("distance_km", haversine_km(F.col("lat"), F.col("lng"), F.col("p_lat"), F.col("p_lng")))
        )
        last = level == LEVELS
        best = top_per_group(near.select(*key, "lat", "place", "distance_km"), key, order, k, ["place"])
        best = materialise(best, "nearest")
        if last:
            done.append(best)
            break
        settled = best.filter(F.col("rank") == k).filter(F.col("distance_km") < _outside_km(F.col("lat"), degrees)).select(*key)
        settled = materialise(settled, "settled")
        done.append(best.join(settled, key, "left_semi"))
        left = materialise(left.join(settled, key, "left_anti"), "points")
        if left.isEmpty():
            break
    out = done[0]
    for other in done[1:]:
        out = out.unionByName(other)
    return out.select(*key, "place", "distance_km", "rank")
