"""Shapes of physical plans that decide how the queries scale."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from tests import model
from wayfleet.config import Sizing
from wayfleet.operators import clean, explore, geofence, motion, replay
from wayfleet.operators.track import Track
from wayfleet.plans.live import LiveAnalysis
from wayfleet.sources import tables


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    path = str(tmp_path_factory.mktemp("fixes") / "table")
    fixes = model.frame(spark, model.random_fixes(71, 20, 30, hot=100))
    tables.write_fixes(fixes, path)
    return tables.read_fixes(spark, path).drop("day")


def plan(rows) -> str:
    return rows._jdf.queryExecution().executedPlan().toString()


def count(rows, node: str) -> int:
    return len(re.findall(rf"(?m)^[^a-zA-Z]*(?:\(\d+\) )?{node}\b", plan(rows)))


def test_motion_uses_one_shuffle_and_one_sort(stored):
    track = Track.of(stored)
    rows = motion.with_running_totals(motion.with_segments(stored, track), track)
    assert count(rows, "Exchange") == 1
    assert count(rows, "Sort") == 1


def test_cleaning_adds_no_sort_before_python(stored):
    moving = stored.filter(~F.col("is_trip_end"))
    rows = clean._screen(moving, Track.of(stored), LiveAnalysis(stored).limits)
    assert count(rows, "Exchange") == 1
    assert count(rows, "Sort") == 1
    assert count(rows, "MapInArrow") == 1


def test_live_chain_shuffles_twice(stored):
    assert count(LiveAnalysis(stored).averages(), "Exchange") == 2


def test_filters_reach_the_scan(stored):
    zone = plan(geofence.inside_zone(stored).select("seq", "is_violated"))
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", zone).group(1)
    assert "latitude" in pushed and "longitude" in pushed
    assert "taxi_id" not in re.search(r"ReadSchema: (.*)", zone).group(1)
    sliced = plan(replay.time_slice(stored, "2008-02-02 13:40:00", "2008-02-02 13:50:00"))
    assert "GreaterThanOrEqual(ts" in sliced and "LessThan(ts" in sliced


def test_fleet_total_has_no_single_task_window(stored):
    analysis = LiveAnalysis(stored, sizing=Sizing(slice_rows=20, max_slices=1000))
    text = plan(analysis.metrics())
    # The only single task is the one over slice sums.
    assert text.count("Exchange SinglePartition") == 1
    below = text[text.index("Exchange SinglePartition"):]
    assert "HashAggregate" in below.splitlines()[1]
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_hot_group_of_repeats_is_split(spark):
    """A semi join against repeated keys splits the task of a hot group."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k) for k in settings}
    rows = spark.range(60_000).select(
        F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).cast("int").alias("taxi_id"),
        F.timestamp_seconds(F.lit(0)).alias("ts"),
        F.rand(1).alias("longitude"),
        F.rand(2).alias("latitude"),
        F.col("id").alias("seq"),
    )
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        found = explore.duplicate_groups(rows)
        assert found.count() == 30_000
        counted = found.agg(F.sum("longitude"), F.sum("latitude"), F.sum("seq"))
        counted.collect()
        assert "SortMergeJoin(skew=true)" in plan(counted)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
