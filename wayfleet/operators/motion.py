"""Segments between consecutive fixes of a vehicle, and what accumulates over
them.  Live definitions first, offline ones after."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfleet.config import LIMITS, Limits
from wayfleet.functions.geo import haversine_km
from wayfleet.functions.rows import flag, speed_or_infinity, speed_or_zero
from wayfleet.functions.time import elapsed_seconds
from wayfleet.operators.track import Track

_PREVIOUS = {
    "previous_latitude": "latitude",
    "previous_longitude": "longitude",
    "previous_timestamp": "ts",
}


def with_previous_fix(fixes: DataFrame, track: Track) -> DataFrame:
    return track.previous(fixes, _PREVIOUS)


def _step_km():
    return haversine_km(
        F.col("previous_latitude"),
        F.col("previous_longitude"),
        F.col("latitude"),
        F.col("longitude"),
    )


def with_segments(
    fixes: DataFrame, track: Track, limits: Limits = LIMITS
) -> DataFrame:
    """Every fix with its distance, seconds, speed and speeding flag since the
    fix before; all NULL on a vehicle's first fix."""
    rows = with_previous_fix(fixes, track)
    seconds = elapsed_seconds(F.col("previous_timestamp"), F.col("ts"))
    has_previous = F.col("previous_timestamp").isNotNull()
    rows = rows.withColumn("segment_km", _step_km()).withColumn("seconds", seconds)
    rows = rows.withColumn(
        "speed", F.when(has_previous, speed_or_zero(F.col("segment_km"), F.col("seconds")))
    )
    return rows.withColumn(
        "is_speeding", F.when(has_previous, flag(F.col("speed") > limits.speeding_kmh))
    ).drop(*_PREVIOUS)


def segments_only(segments: DataFrame) -> DataFrame:
    # Tested on the time, so that no distance is computed twice.
    return segments.filter(F.col("seconds").isNotNull())


def with_running_totals(segments: DataFrame, track: Track) -> DataFrame:
    """Distance, time and mean of segment speeds of a vehicle so far.  The mean
    is unweighted and 0 before the first segment."""
    rows = track.running_sums(
        segments,
        {
            "taxi_distance": F.coalesce("segment_km", F.lit(0.0)),
            "elapsed_seconds": F.coalesce("seconds", F.lit(0.0)),
            "_speed_sum": F.coalesce("speed", F.lit(0.0)),
            "_speed_n": F.when(F.col("speed").isNotNull(), 1).otherwise(0),
        },
    )
    mean = F.when(F.col("_speed_n") > 0, F.col("_speed_sum") / F.col("_speed_n"))
    return rows.withColumn("average_speed", F.coalesce(mean, F.lit(0.0))).drop(
        "_speed_sum", "_speed_n"
    )


def taxi_totals(segments: DataFrame) -> DataFrame:
    """Final values per vehicle; partial aggregation, no window."""
    return segments.groupBy("taxi_id").agg(
        F.coalesce(F.sum("segment_km"), F.lit(0.0)).alias("taxi_distance"),
        F.coalesce(F.sum("seconds"), F.lit(0.0)).alias("elapsed_seconds"),
        F.coalesce(F.avg("speed"), F.lit(0.0)).alias("average_speed"),
        F.count("speed").alias("segments"),
    )


def fleet_total(segments: DataFrame) -> DataFrame:
    return segments.agg(
        F.coalesce(F.sum("segment_km"), F.lit(0.0)).alias("total_distance")
    )


def fleet_running_distance(segments: DataFrame, fleet: Track) -> DataFrame:
    """Distance of the whole fleet after each segment (rows without a segment
    left out before).  ``fleet`` is a track without keys, ordered by time."""
    return fleet.running_sums(segments, {"total_distance": F.col("segment_km")})


def speed_history(segments: DataFrame, track: Track, page: int = 1000) -> DataFrame:
    """Speeds of a vehicle in order, as pages of at most ``page`` values, so no
    row grows with the length of the history."""
    rows = track.running_sums(segments_only(segments), {"_nth": F.lit(1)})
    entry = F.struct("_nth", "speed")
    return (
        rows.withColumn("page", F.floor((F.col("_nth") - 1) / page).cast("bigint"))
        .groupBy("taxi_id", "page")
        .agg(F.sort_array(F.collect_list(entry)).alias("_entries"))
        .select("taxi_id", "page", F.col("_entries.speed").alias("speeds"))
    )


# -- offline definitions ------------------------------------------------------


def with_steps(fixes: DataFrame, track: Track) -> DataFrame:
    """Previous fix, step distance, hours and speed.  A move in no time has
    infinite speed, a repeat in no time has none."""
    rows = with_previous_fix(fixes, track)
    hours = elapsed_seconds(F.col("previous_timestamp"), F.col("ts")) / 3600
    return (
        rows.withColumn("distance_between_points", _step_km())
        .withColumn("time_diff_hours", hours)
        .withColumn(
            "speed",
            speed_or_infinity(F.col("distance_between_points"), F.col("time_diff_hours")),
        )
    )


def abnormal_jumps(steps: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    return steps.filter(F.col("distance_between_points") > limits.jump_km)


def faster_than(steps: DataFrame, kmh: float) -> DataFrame:
    return steps.filter(F.col("speed") > kmh)


def distance_over_time(steps: DataFrame, by_taxi: Track) -> DataFrame:
    """Total over all vehicles in (vehicle, time) order; the very first row
    emits nothing.  ``by_taxi`` is a track without keys in that order."""
    rows = by_taxi.running_sums(
        steps,
        {
            "total_distance": F.coalesce("distance_between_points", F.lit(0.0)),
            "_nth": F.lit(1),
        },
    )
    return rows.filter(F.col("_nth") > 1).drop("_nth")
