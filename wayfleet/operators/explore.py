"""Exploratory checks on a table of fixes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfleet.config import FIX_COLUMNS


def drop_duplicate_rows(
    fixes: DataFrame, columns: Sequence[str] = FIX_COLUMNS
) -> DataFrame:
    """One row per distinct data row, with the sequence number of its first
    copy.  Copies collapse before the shuffle, however many there are."""
    others = [c for c in fixes.columns if c not in (*columns, "seq")]
    rest = [F.min_by(c, "seq").alias(c) for c in others]
    return fixes.groupBy(*columns).agg(F.min("seq").alias("seq"), *rest)


def duplicate_groups(
    fixes: DataFrame, columns: Sequence[str] = ("taxi_id", "ts")
) -> DataFrame:
    """Every member of a group that shares ``columns`` with another row.

    Group sizes are counted with map-side combining and only the repeated keys
    go into a semi join, whose large side can be split where it is skewed; a
    window over the group would hold the whole group in one task.
    """
    repeated = (
        fixes.groupBy(*columns)
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > 1)
        .drop("_n")
    )
    return fixes.join(repeated, list(columns), "left_semi")


def value_counts(rows: DataFrame, column: str, into: str = "count") -> DataFrame:
    """Rows per value, most frequent first."""
    return (
        rows.groupBy(column)
        .agg(F.count(F.lit(1)).alias(into))
        .orderBy(F.desc(into), column)
    )


def of_taxi(rows: DataFrame, taxi_id: int) -> DataFrame:
    return rows.filter(F.col("taxi_id") == taxi_id)


def head(rows: DataFrame, n: int = 5) -> DataFrame:
    """First rows in time order (top-k per task, no full sort)."""
    return rows.orderBy("ts", "seq").limit(n)


def sorted_by_time(rows: DataFrame) -> DataFrame:
    return rows.orderBy("ts", "is_trip_end", "seq")


def profile(rows: DataFrame) -> DataFrame:
    """Per column: position, name, type, number of values and of NULLs; one
    aggregate over the table."""
    counts = rows.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count(c).alias(f"_c{i}") for i, c in enumerate(rows.columns)],
    )
    entries = F.array(
        *[
            F.struct(
                F.lit(i).alias("position"),
                F.lit(field.name).alias("column_name"),
                F.lit(field.dataType.simpleString()).alias("column_type"),
                F.col(f"_c{i}").alias("non_null"),
                (F.col("_rows") - F.col(f"_c{i}")).alias("nulls"),
            )
            for i, field in enumerate(rows.schema.fields)
        ]
    )
    return counts.select(F.inline(entries))
