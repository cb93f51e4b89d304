"""Time slices of a table of fixes, as a replay would send them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def time_slice(fixes: DataFrame, start: str, end: str) -> DataFrame:
    """Half-open: ``start <= ts < end``."""
    return fixes.filter(
        (F.col("ts") >= F.lit(start).cast("timestamp"))
        & (F.col("ts") < F.lit(end).cast("timestamp"))
    )


def replay_slices(fixes: DataFrame, start: str, end: str, step_seconds: int) -> DataFrame:
    """Fixes a replay from ``start`` sends, with the number of the step that
    sends them.  Steps begin while their start is not after ``end``, so the
    last one may run past it by less than a step."""
    first = F.unix_seconds(F.lit(start).cast("timestamp"))
    span = F.unix_seconds(F.lit(end).cast("timestamp")) - first
    stop = F.timestamp_seconds(
        first + (F.floor(span / step_seconds) + 1) * step_seconds
    )
    passed = F.unix_seconds("ts") - first
    return fixes.filter(
        (F.col("ts") >= F.lit(start).cast("timestamp")) & (F.col("ts") < stop)
    ).withColumn("slice_id", F.floor(passed / step_seconds).cast("bigint"))
