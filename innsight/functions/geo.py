"""Distance and grid-cell expressions (GEO1, GEO2, GEO3, GEO4)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from .cleaning import _c

# Fixed values.
EARTH_RADIUS_KM = 6371.0
KM_PER_DEGREE = 111.0
CITY_CENTRE = (-33.9249, 18.4241)


def haversine_km(lat1, lon1, lat2, lon2, radius: float = EARTH_RADIUS_KM) -> Column:
    """GEO1: great-circle distance in km."""
    p1, p2 = F.radians(_c(lat1)), F.radians(_c(lat2))
    dlat = p2 - p1
    dlon = F.radians(_c(lon2)) - F.radians(_c(lon1))
    a = F.pow(F.sin(dlat / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlon / 2), 2)
    return F.lit(2 * radius) * F.asin(F.sqrt(a))


def flat_distance_km(lat, lon, centre=CITY_CENTRE) -> Column:
    """GEO2: equirectangular distance to a centre point."""
    lat0, lon0 = centre
    dy = (_c(lat) - lat0) * KM_PER_DEGREE
    dx = (_c(lon) - lon0) * KM_PER_DEGREE * math.cos(math.radians(lat0))
    return F.sqrt(dy * dy + dx * dx)


def square_cell(lat, lon, size_deg: float) -> tuple[Column, Column]:
    """GEO4: square grid cell indices."""
    return (F.floor(_c(lat) / size_deg).cast("long"), F.floor(_c(lon) / size_deg).cast("long"))


def hex_cell(x, y, xmin, xmax, ymin, ymax, gridsize: int = 60) -> Column:
    """GEO3: hexagon cell id on the two offset lattices used by matplotlib's
    hexbin (public behaviour): nx = gridsize, ny = int(gridsize / sqrt(3));
    the nearer of the two lattice centres wins (distance dx^2 + 3 dy^2)."""
    nx = gridsize
    ny = int(gridsize / math.sqrt(3))
    # all points on one line: no extent, one cell across
    sx = F.when(xmax > xmin, F.lit(nx) / F.nullif(xmax - xmin, F.lit(0.0))).otherwise(0.0)
    sy = F.when(ymax > ymin, F.lit(ny) / F.nullif(ymax - ymin, F.lit(0.0))).otherwise(0.0)
    ix = (_c(x) - xmin) * sx
    iy = (_c(y) - ymin) * sy
    ix1, iy1 = F.bround(ix), F.bround(iy)
    ix2, iy2 = F.floor(ix), F.floor(iy)
    d1 = F.pow(ix - ix1, 2) + 3.0 * F.pow(iy - iy1, 2)
    d2 = F.pow(ix - ix2 - 0.5, 2) + 3.0 * F.pow(iy - iy2 - 0.5, 2)
    nx1, ny1 = nx + 1, ny + 1
    on_first = d1 < d2
    first_id = ix1.cast("long") * ny1 + iy1.cast("long")
    second_id = F.lit(nx1 * ny1) + ix2.cast("long") * ny + iy2.cast("long")
    return F.when(on_first, first_id).otherwise(second_id)
