"""Named parameters of the fleet analysis.

The numbers below are fixed values: results depend on them, so they are stated
once, here, and passed around as parameters.
"""

from __future__ import annotations

from dataclasses import dataclass

# Mean earth radius used by the great-circle distance, and the
# coordinate both axes take in an end-of-trip marker row.
EARTH_RADIUS_KM = 6372.8
MARKER_COORDINATE = -1.0

# Timestamp text layouts.  Reading takes unpadded parts as well,
# writing always pads.
READ_TIMESTAMP = "yyyy-M-d H:m:s"
WRITE_TIMESTAMP = "yyyy-MM-dd HH:mm:ss"

# Names of the message topics.
INPUT_TOPIC = "taxi"
ACTIVE, ENDED, METRICS, SPEEDS, AVERAGES = (
    "active_taxi",
    "ended_taxi",
    "metrics",
    "over_speeding",
    "avg_speed",
)
OUTPUT_TOPICS = (ACTIVE, ENDED, METRICS, SPEEDS, AVERAGES)

# Texts of served documents.
PERMITTED_TEXT = "Taxi operating within permitted area"
RESTRICTED_TEXT = "Taxi has entered a restricted area"


@dataclass(frozen=True)
class Zone:
    """A circular zone; fixes beyond ``radius_km`` leave the analysis and
    those beyond ``warn_km`` are flagged."""

    latitude: float = 39.9163447
    longitude: float = 116.3971556
    warn_km: float = 10.0
    radius_km: float = 15.0


@dataclass(frozen=True)
class Limits:
    """Thresholds; each one is exceeded strictly (a value equal to it passes)."""

    max_speed_kmh: float = 300.0
    speeding_kmh: float = 50.0
    very_high_kmh: float = 150.0
    jump_km: float = 15.0
    lateness: str = "10 seconds"


@dataclass(frozen=True)
class Sizing:
    """How rows are cut into tasks.

    A vehicle with more than ``slice_rows`` rows is cut into slices of about
    that size.  ``max_slices`` bounds everything that is broadcast or held by
    the driver: with more data the slices grow, their number does not.
    """

    slice_rows: int = 4_000_000
    max_slices: int = 200_000


ZONE = Zone()
LIMITS = Limits()
SIZING = Sizing()

# Order of one vehicle's rows: time first, a marker after the fixes of its
# second, then the source's own sequence number (line, offset or event id).
ROW_ORDER = ("ts", "is_trip_end", "seq")
FIX_COLUMNS = ("taxi_id", "ts", "longitude", "latitude")
