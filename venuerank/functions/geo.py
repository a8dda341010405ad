"""Column expressions for distances, grid cells and compass labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0
CELL_DEGREES = 0.1

# The label of a cell relative to its city's centre.
COMPASS_POINTS = ["North", "Northeast", "East", "Southeast", "South", "Southwest", "West", "Northwest"]
CENTRE_LABEL, CENTRE_DEGREES = "Downtown", 0.1
RINGS = [("District", 0.25), ("Side", 0.45)]
OUTER_RING = "Outskirts"


def haversine_km(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Great-circle distance in kilometres."""
    chord = (
        F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2)
        + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lng2 - lng1) / 2), 2)
    )
    # rounding can push the chord of antipodal points just past 1
    chord = F.least(F.greatest(chord, F.lit(0.0)), F.lit(1.0))
    return 2 * EARTH_RADIUS_KM * F.atan2(F.sqrt(chord), F.sqrt(1 - chord))


def cell_index(degrees: Column) -> Column:
    return F.floor(degrees / F.lit(CELL_DEGREES))


def grid_cell(lat: Column, lng: Column) -> Column:
    """Key of the 0.1-degree cell holding a point: its south-west corner as ``lat_lng``."""
    corners = [F.format_number(cell_index(c) * F.lit(CELL_DEGREES), 1) for c in (lat, lng)]
    return F.concat_ws("_", *corners)


def with_grid_cell(df, lat: str = "latitude", lng: str = "longitude"):
    located = F.col(lat).isNotNull() & F.col(lng).isNotNull()
    return df.withColumn("grid_cell", F.when(located, grid_cell(F.col(lat), F.col(lng))))


def _corner(cell: Column, part: int) -> Column:
    return F.get(F.split(cell, "_"), F.lit(part)).try_cast("double")


def compass_label(cell: Column, city_lat: Column, city_lng: Column) -> Column:
    """Neighbourhood name of a cell from its offset to the city centre, in plain degrees.

    A key that is not two numbers joined by ``_`` is returned as it is.
    """
    d_lat = _corner(cell, 0) + CELL_DEGREES / 2 - city_lat
    d_lng = _corner(cell, 1) + CELL_DEGREES / 2 - city_lng
    distance = F.sqrt(d_lat * d_lat + d_lng * d_lng)
    bearing = F.pmod(90 - F.degrees(F.atan2(d_lat, d_lng)), F.lit(360.0))
    sector = F.floor(F.pmod(bearing + 22.5, F.lit(360.0)) / 45).cast("int")
    point = F.get(F.array(*[F.lit(p) for p in COMPASS_POINTS]), sector)
    ring = F.lit(OUTER_RING)
    for name, limit in reversed(RINGS):
        ring = F.when(distance < limit, F.lit(name)).otherwise(ring)
    parsed = (F.size(F.split(cell, "_")) == 2) & _corner(cell, 0).isNotNull() & _corner(cell, 1).isNotNull()
    return (
        F.when(~parsed, cell)
        .when(distance < CENTRE_DEGREES, F.lit(CENTRE_LABEL))
        .otherwise(F.concat_ws(" ", point, ring))
    )


def cell_bounds(cell: Column, center_lat: Column, center_lng: Column) -> dict[str, Column]:
    """South, west, north and east edge of a cell; an unreadable key falls back to the centre."""
    readable = _corner(cell, 0).isNotNull() & _corner(cell, 1).isNotNull()
    south = F.when(readable, _corner(cell, 0)).otherwise(center_lat - CELL_DEGREES / 2)
    west = F.when(readable, _corner(cell, 1)).otherwise(center_lng - CELL_DEGREES / 2)
    return {"south": south, "west": west, "north": south + CELL_DEGREES, "east": west + CELL_DEGREES}


def valid_coordinate(value: Column) -> Column:
    number = value.try_cast("double")
    return number.isNotNull() & ~F.isnan(number)
