"""End-of-trip markers and trip counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfleet.config import MARKER_COORDINATE
from wayfleet.operators.track import Track


def trip_end_rows(fixes: DataFrame, source: Sequence[str], last: str = "seq") -> DataFrame:
    """One marker per source file: the vehicle, time and sequence number of the
    file's last row at the marker coordinate.  Sources without rows have none."""
    tail = F.max_by(F.struct("taxi_id", "ts", "seq"), last)
    return (
        fixes.groupBy(*source)
        .agg(tail.alias("_tail"))
        .select(
            *source,
            F.col("_tail.taxi_id").alias("taxi_id"),
            F.col("_tail.ts").alias("ts"),
            F.lit(MARKER_COORDINATE).alias("longitude"),
            F.lit(MARKER_COORDINATE).alias("latitude"),
            F.col("_tail.seq").alias("seq"),
            F.lit(True).alias("is_trip_end"),
        )
    )


def with_trip_ends(fixes: DataFrame, source: Sequence[str], last: str = "seq") -> DataFrame:
    return fixes.unionByName(trip_end_rows(fixes, source, last))


def split_markers(fixes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(moving fixes, markers)"""
    return fixes.filter(~F.col("is_trip_end")), fixes.filter("is_trip_end")


def ended_running(fixes: DataFrame, track: Track) -> DataFrame:
    """Running count of markers per vehicle."""
    return track.running_sums(
        fixes.filter("is_trip_end"), {"ended_trip_count": F.lit(1).cast("bigint")}
    )


def ended_per_taxi(fixes: DataFrame) -> DataFrame:
    return (
        fixes.filter("is_trip_end")
        .groupBy("taxi_id")
        .agg(F.count(F.lit(1)).alias("ended_trip_count"))
    )


def ended_fleet(fixes: DataFrame) -> DataFrame:
    """Trips ended over the whole fleet; 0 before any has."""
    return fixes.agg(
        F.count(F.when(F.col("is_trip_end"), 1)).alias("ended_trip_count")
    )
