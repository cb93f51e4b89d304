"""Zone test with a warning band."""

from __future__ import annotations

from math import asin, cos, degrees, radians, sin

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfleet.config import EARTH_RADIUS_KM, ZONE, Zone
from wayfleet.functions.geo import distance_to_zone_km
from wayfleet.functions.rows import flag

DISTANCE = "distance_to_forbidden_city"


def near_zone(zone: Zone) -> Column:
    """Plain ranges that hold for every fix of the zone, and for few others.

    Plain comparisons of stored columns reach the Parquet scan, where they skip
    row groups, and they spare most far fixes the distance.  A coordinate out of
    the usual range may wrap around into the zone, so it passes.
    """
    slack = 1 + 1e-9
    reach = zone.radius_km / EARTH_RADIUS_KM * slack
    north, south = (zone.latitude + d * degrees(reach) for d in (1, -1))
    latitude, longitude = F.col("latitude"), F.col("longitude")
    within = latitude.between(south, north) | ~latitude.between(-90.0, 90.0)
    if -89 < south and north < 89:
        width = degrees(asin(sin(reach) / cos(radians(zone.latitude)))) * slack
        west, east = zone.longitude - width, zone.longitude + width
        if -180 < west and east < 180:
            within = within & (
                longitude.between(west, east) | ~longitude.between(-180.0, 180.0)
            ) | ~latitude.between(-90.0, 90.0)
    return within


def inside_zone(fixes: DataFrame, zone: Zone = ZONE) -> DataFrame:
    """Keep fixes within the zone, with their distance to its centre and a 0/1
    flag for the outer band."""
    km = F.col(DISTANCE)
    return (
        fixes.filter(near_zone(zone))
        .withColumn(DISTANCE, distance_to_zone_km(zone))
        .filter(km <= zone.radius_km)
        .withColumn(
            "is_violated", flag((km > zone.warn_km) & (km <= zone.radius_km))
        )
    )


def band_counts(active: DataFrame) -> DataFrame:
    return active.groupBy("is_violated").agg(
        F.count(F.lit(1)).alias("fixes"),
        F.count_distinct("taxi_id").alias("taxis"),
        F.max(DISTANCE).alias("max_distance"),
    )
