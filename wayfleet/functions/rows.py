"""Predicates and value helpers shared by several operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wayfleet.config import MARKER_COORDINATE


def trip_end() -> Column:
    """True for an end-of-trip marker row."""
    return (F.col("latitude") == MARKER_COORDINATE) & (
        F.col("longitude") == MARKER_COORDINATE
    )


def is_finite(value: Column) -> Column:
    """False for NULL, NaN and infinite numbers."""
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf"))


def flag(condition: Column) -> Column:
    """0/1 integer; an unknown condition counts as 0."""
    return F.when(condition, 1).otherwise(0)


def speed_or_zero(km: Column, seconds: Column) -> Column:
    """km/h; 0 where no time passed (live definition)."""
    return F.when(seconds > 0, km / seconds * 3600).otherwise(F.lit(0.0))


def speed_or_infinity(km: Column, hours: Column) -> Column:
    """km/h; infinite for a move in no time and NULL for no move in no time
    (offline definition).  NaN never arises, since it would exceed any limit."""
    return F.when(hours > 0, km / hours).when(
        (hours == 0) & (km > 0), F.lit(float("inf"))
    )
