"""The offline analysis of a stored table of fixes."""

from __future__ import annotations

from copy import copy

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfleet.config import LIMITS, SIZING, ZONE, Limits, Sizing, Zone
from wayfleet.functions.geo import distance_to_zone_km
from wayfleet.operators import explore, motion, trips
from wayfleet.operators.geofence import near_zone
from wayfleet.operators.track import Track

TAXI_ORDER = ("taxi_id", "ts", "seq")
CENTRE_DISTANCE = "distance_from_forbidden_city"


class OfflineAnalysis:
    """Plans over raw fixes, copies and markers included."""

    def __init__(
        self,
        raw: DataFrame,
        zone: Zone = ZONE,
        limits: Limits = LIMITS,
        sizing: Sizing = SIZING,
        track: Track | None = None,
        by_taxi: Track | None = None,
    ):
        self.raw, self.zone, self.limits = raw, zone, limits
        self.track = track or Track.of(raw, sizing=sizing)
        self._by_taxi, self._sizing = by_taxi, sizing
        self._steps: DataFrame | None = None

    def staged(self, folder: str) -> "OfflineAnalysis":
        """The same analysis with the steps written to shared storage once; a
        running total needs them twice, for its slices and for themselves."""
        path = f"{folder}/steps"
        self.steps().write.mode("overwrite").parquet(path)
        analysis = copy(self)
        analysis._steps = self.raw.sparkSession.read.parquet(path)
        return analysis

    @property
    def by_taxi(self) -> Track:
        if self._by_taxi is None:
            self._by_taxi = Track.of(self.raw, (), TAXI_ORDER, self._sizing)
        return self._by_taxi

    def distinct_rows(self) -> DataFrame:
        return explore.drop_duplicate_rows(self.raw)

    def repeated_times(self) -> DataFrame:
        moving, _ = trips.split_markers(self.distinct_rows())
        return explore.duplicate_groups(moving)

    def within_radius(self) -> DataFrame:
        near = self.distinct_rows().filter(near_zone(self.zone))
        return near.withColumn(
            CENTRE_DISTANCE, distance_to_zone_km(self.zone)
        ).filter(F.col(CENTRE_DISTANCE) <= self.zone.radius_km)

    def steps(self) -> DataFrame:
        if self._steps is not None:
            return self._steps
        return self.track.unmark(motion.with_steps(self.within_radius(), self.track))

    def abnormal_jumps(self) -> DataFrame:
        return motion.abnormal_jumps(self.steps(), self.limits)

    def high_speed(self) -> DataFrame:
        return motion.faster_than(self.steps(), self.limits.speeding_kmh)

    def distance_over_time(self) -> DataFrame:
        return self.by_taxi.unmark(
            motion.distance_over_time(self.steps(), self.by_taxi)
        )
