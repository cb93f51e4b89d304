"""Fixes derived from a table of events, for data without positions.

Integer arithmetic on the event and user ids places every user on a fixed spot
and every event near it; one event in 97 is thrown two degrees east.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfleet.functions.rows import trip_end

_FIRST_SECOND = 1201959000  # 2008-02-02 13:30:00


def event_fixes(events: DataFrame) -> DataFrame:
    event, user = F.col("event_id"), F.col("user_id")
    second = F.lit(_FIRST_SECOND) + F.expr("event_id div 8") * 8
    longitude = (
        F.lit(116.3971556)
        + ((user * 7919) % 240 - 120) / F.lit(1000.0)
        + ((event * 37) % 41 - 20) / F.lit(1000.0)
        + F.when(event % 97 == 0, 2.0).otherwise(0.0)
    )
    latitude = (
        F.lit(39.9163447)
        + ((user * 104729) % 200 - 100) / F.lit(1000.0)
        + ((event * 53) % 31 - 15) / F.lit(1000.0)
    )
    return events.select(
        user.cast("int").alias("taxi_id"),
        F.timestamp_seconds(second).alias("ts"),
        longitude.alias("longitude"),
        latitude.alias("latitude"),
        event.alias("seq"),
    ).withColumn("is_trip_end", trip_end())


def read_event_fixes(spark: SparkSession, folder: str) -> DataFrame:
    return event_fixes(spark.read.parquet(f"{folder}/events.parquet"))


def with_copies(fixes: DataFrame) -> DataFrame:
    """A second copy of every fiftieth row."""
    copies = F.when(F.col("seq") % 50 == 0, F.array(F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(0))
    )
    return fixes.withColumn("_copy", F.explode(copies)).drop("_copy")


def as_log_lines(fixes: DataFrame) -> DataFrame:
    """The fixes as log lines, some of them damaged: one in 211 loses its last
    field, one in 223 has no timestamp, and one in 227 and one in 229 are at no
    finite place."""
    stamp = F.when(F.col("seq") % 223 == 0, "bad").otherwise(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    )
    longitude = (
        F.when(F.col("seq") % 227 == 0, "NaN")
        .when(F.col("seq") % 229 == 0, "Infinity")
        .otherwise(F.col("longitude").cast("string"))
    )
    lead = F.concat_ws(",", F.col("taxi_id").cast("string"), stamp, longitude)
    value = F.when(F.col("seq") % 211 == 0, lead).otherwise(
        F.concat_ws(",", lead, F.col("latitude").cast("string"))
    )
    return fixes.select(value.alias("value"), "seq")
