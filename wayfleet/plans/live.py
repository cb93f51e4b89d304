"""The live analysis as batch plans: clean, zone test, then five outputs."""

from __future__ import annotations

import uuid
from copy import copy

from pyspark.sql import DataFrame

from wayfleet.config import (
    ACTIVE,
    AVERAGES,
    ENDED,
    LIMITS,
    METRICS,
    SIZING,
    SPEEDS,
    ZONE,
    Limits,
    Sizing,
    Zone,
)
from wayfleet.operators import clean, geofence, motion, trips
from wayfleet.operators.track import Track
from wayfleet.session import shared_folder

FLEET_ORDER = ("ts", "taxi_id", "seq")


class LiveAnalysis:
    """Plans over one table of fixes; nothing runs before an action, except the
    row counts that decide how vehicles are sliced."""

    def __init__(
        self,
        fixes: DataFrame,
        zone: Zone = ZONE,
        limits: Limits = LIMITS,
        trip_end: str = "intent",
        sizing: Sizing = SIZING,
        track: Track | None = None,
        fleet: Track | None = None,
    ):
        self.fixes = fixes
        self.zone, self.limits, self.trip_end = zone, limits, trip_end
        self.track = track or Track.of(fixes, sizing=sizing)
        self._fleet, self._sizing = fleet, sizing
        self._staged: DataFrame | None = None

    @property
    def fleet(self) -> Track:
        if self._fleet is None:
            self._fleet = Track.of(self.fixes, (), FLEET_ORDER, self._sizing)
        return self._fleet

    def screened(self) -> DataFrame:
        return clean.screen_fixes(self.fixes, self.track, self.limits, self.trip_end)

    def cleaned(self) -> DataFrame:
        return clean.clean_fixes(self.fixes, self.track, self.limits, self.trip_end)

    def staged(self, folder: str) -> "LiveAnalysis":
        """The same analysis with the active fixes written to shared storage
        once; several outputs then share one cleaning pass."""
        path = f"{folder}/active_fixes"
        self.active().write.mode("overwrite").parquet(path)
        analysis = copy(self)
        analysis._staged = self.fixes.sparkSession.read.parquet(path)
        return analysis

    def active(self) -> DataFrame:
        if self._staged is not None:
            return self._staged
        return geofence.inside_zone(self.cleaned(), self.zone)

    def _active_for(self, *tracks: Track) -> DataFrame:
        """Active fixes for operators over ``tracks``.  Slices need the rows
        twice, for their summaries and for themselves, and Spark cannot share
        what a Python stage has produced; so they are staged once."""
        if self._staged is None and any(track.sliced for track in tracks):
            spark = self.fixes.sparkSession
            folder = f"{shared_folder(spark)}/active-{uuid.uuid4().hex}"
            self._staged = self.staged(folder)._staged
        return self.active()

    def ended(self) -> DataFrame:
        """Markers go around the zone test, which none could pass; in
        ``as_wired`` mode they do not."""
        if self.trip_end == "intent":
            # Cleaning passes every marker, so they come from the fixes.
            rows = self.fixes
        else:
            rows = self.active()
        return self.track.unmark(trips.ended_running(rows, self.track))

    def segments(self) -> DataFrame:
        rows = self._active_for(self.track)
        return motion.with_segments(rows, self.track, self.limits)

    def speeds(self) -> DataFrame:
        return self.track.unmark(motion.segments_only(self.segments()))

    def averages(self) -> DataFrame:
        totals = motion.with_running_totals(self.segments(), self.track)
        return self.track.unmark(totals)

    def metrics(self) -> DataFrame:
        self._active_for(self.fleet)
        rows = self.speeds()
        return self.fleet.unmark(motion.fleet_running_distance(rows, self.fleet))

    def outputs(self) -> dict[str, DataFrame]:
        at = ["taxi_id", "ts", "seq"]
        place = ["longitude", "latitude"]
        return {
            ACTIVE: self.active().select(*at, *place, geofence.DISTANCE, "is_violated"),
            ENDED: self.ended().select(*at, "ended_trip_count"),
            METRICS: self.metrics().select(*at, "total_distance"),
            SPEEDS: self.speeds().select(*at, *place, "speed", "is_speeding"),
            AVERAGES: self.averages().select(*at, "average_speed"),
        }

    def write_outputs(self, folder: str) -> None:
        """The five outputs as tables under ``folder``."""
        for name, rows in self.staged(folder).outputs().items():
            rows.write.mode("overwrite").parquet(f"{folder}/{name}")


__all__ = ["FLEET_ORDER", "LiveAnalysis"]
