"""Timestamp text, differences and epoch values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wayfleet.config import READ_TIMESTAMP, WRITE_TIMESTAMP


def parse_timestamp(text: Column) -> Column:
    """NULL where the text is not a timestamp; padding of parts is optional."""
    return F.try_to_timestamp(text, F.lit(READ_TIMESTAMP))


def format_timestamp(ts: Column) -> Column:
    return F.date_format(ts, WRITE_TIMESTAMP)


def elapsed_seconds(earlier: Column, later: Column) -> Column:
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(1e6)


def event_time_ms(ts: Column) -> Column:
    return F.unix_millis(ts)
