"""Great-circle distance."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0

# Map centre of each borough.
BOROUGH_CENTERS = {
    "BRONX": (40.845, -73.865),
    "BROOKLYN": (40.650, -73.950),
    "MANHATTAN": (40.775, -73.970),
    "QUEENS": (40.730, -73.795),
    "STATEN ISLAND": (40.580, -74.150),
}
CITY_CENTER = (40.730, -73.935)


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Rounding can push the half-chord past 1, hence the clamp before the arc sine."""
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    chord = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    bounded = F.when(chord > 1, 1.0).when(chord < 0, 0.0).otherwise(chord)
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(bounded))


def map_view(borough: str | None) -> tuple[float, float, int]:
    """Centre and zoom for one selected borough, or for the whole city."""
    if borough in BOROUGH_CENTERS:
        return (*BOROUGH_CENTERS[borough], 12)
    return (*CITY_CENTER, 12 if borough else 10)
