"""Great-circle distance as a Column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wayfleet.config import EARTH_RADIUS_KM, Zone


def haversine_km(lat_a, lon_a, lat_b, lon_b) -> Column:
    """Kilometres between two points given in degrees (columns or numbers)."""
    lat_a, lon_a, lat_b, lon_b = (
        c if isinstance(c, Column) else F.lit(float(c))
        for c in (lat_a, lon_a, lat_b, lon_b)
    )
    half_lat = F.sin(F.radians(lat_b - lat_a) / 2)
    half_lon = F.sin(F.radians(lon_b - lon_a) / 2)
    chord = half_lat * half_lat + (
        F.cos(F.radians(lat_a)) * F.cos(F.radians(lat_b)) * half_lon * half_lon
    )
    # Rounding may push the chord a hair above 1 for antipodal points.  A missing
    # point stays missing and NaN stays NaN, which Spark orders above 1.
    above = (chord > 1) & ~F.isnan(chord)
    return 2 * EARTH_RADIUS_KM * F.asin(F.when(above, 1.0).otherwise(F.sqrt(chord)))


def distance_to_zone_km(zone: Zone) -> Column:
    return haversine_km(
        F.col("latitude"), F.col("longitude"), zone.latitude, zone.longitude
    )
