"""Served documents: shapes per topic and the latest document per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfleet.config import PERMITTED_TEXT, RESTRICTED_TEXT


def latest_by_key(
    rows: DataFrame,
    keys: Sequence[str] = ("taxi_id",),
    order: Sequence[str] = ("ts", "is_trip_end", "seq"),
) -> DataFrame:
    """Last row per key (or over all rows, without keys).  A partial
    aggregation: each task hands on one row per key."""
    rest = [c for c in rows.columns if c not in keys]
    last = F.max_by(F.struct(*rest), F.struct(*order)).alias("_last")
    found = rows.groupBy(*keys).agg(last)
    if not keys:
        found = found.filter(F.col("_last").isNotNull())
    return found.select(*keys, "_last.*").select(*rows.columns)


def without_ended(latest: DataFrame) -> DataFrame:
    """A marker as the latest row deletes the vehicle's document."""
    return latest.filter(~F.col("is_trip_end"))


def active_document(active: DataFrame) -> DataFrame:
    moved = ("longitude", "latitude")
    return active.select(
        *[c for c in active.columns if c not in moved],
        F.struct(
            F.col("longitude").alias("lon"), F.col("latitude").alias("lat")
        ).alias("location"),
        taxi_description().alias("taxi_description"),
        F.when(F.col("is_violated") == 0, PERMITTED_TEXT)
        .otherwise(RESTRICTED_TEXT)
        .alias("is_violated_text"),
    )


def taxi_document(rows: DataFrame) -> DataFrame:
    """Shape of speed and average documents."""
    return rows.withColumn("taxi_description", taxi_description())


def metrics_document(rows: DataFrame) -> DataFrame:
    """Whole kilometres, cut toward zero, and their text."""
    whole = F.col("total_distance").cast("bigint")
    return rows.withColumn("total_distance", whole).withColumn(
        "total_distance_string",
        F.concat(F.col("total_distance").cast("string"), F.lit(" Km")),
    )


def taxi_description():
    return F.concat(F.lit("Taxi "), F.col("taxi_id").cast("string"))


DOCUMENTS = {
    "active_taxi": active_document,
    "metrics": metrics_document,
    "over_speeding": taxi_document,
    "avg_speed": taxi_document,
    "ended_taxi": lambda rows: rows,
}


def document_for(topic: str, rows: DataFrame) -> DataFrame:
    """Transform chosen by topic."""
    return DOCUMENTS[topic](rows)
