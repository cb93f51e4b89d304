"""Where vehicles stand at the end of a batch analysis, for a stream to go on from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfleet.plans.live import LiveAnalysis
from wayfleet.streaming.processor import PROGRESS


def starting_state(past: LiveAnalysis) -> DataFrame:
    """A row per vehicle of the fixes that ``past`` has analysed: last accepted
    fix, last fix inside the zone, running values and newest time.

    Aggregates by vehicle, combined before they are shuffled; no history meets
    in one task.  Nothing of the past waits: a stream with this state begins
    after it, and fixes from before ``lateness`` of its end count as late."""
    at = F.struct("ts", "is_trip_end", "seq")
    us = F.unix_micros("ts")

    def last(prefix: str):
        found = F.struct(F.col("latitude").alias("lat"), F.col("longitude").alias("lon"), us.alias("us"))
        return F.max_by(found, at).alias(prefix)

    screened = past.screened().filter("reject_reason IS NULL")
    inside = past.segments()
    if past.trip_end == "intent":  # markers are no places, and all count
        screened = screened.filter("NOT is_trip_end")
        ended = F.count_if("is_trip_end")
    else:  # none is inside the zone, so none counts
        ended = F.lit(0)
    newest = past.fixes.groupBy("taxi_id").agg(F.max(us).alias("newest"), ended.cast("long").alias("ended"))
    accepted = screened.groupBy("taxi_id").agg(last("ok"))
    inside = inside.groupBy("taxi_id").agg(
        last("in"),
        F.sum("segment_km").alias("km"),
        F.sum("seconds").alias("seconds"),
        F.sum("speed").alias("speed_sum"),
        F.count("speed").alias("speed_n"),
    )
    joined = newest.join(accepted, "taxi_id", "left").join(inside, "taxi_id", "left")
    values = {f"{side}_{part}": F.col(f"{side}.{part}") for side in ("ok", "in") for part in ("lat", "lon", "us")}
    values |= {name: F.coalesce(name, F.lit(0.0)) for name in ("km", "seconds", "speed_sum")}
    values |= {"speed_n": F.coalesce("speed_n", F.lit(0).cast("long")), "ended": F.col("ended")}
    return joined.select("taxi_id", *[values[name].alias(name) for name in PROGRESS], "newest")
