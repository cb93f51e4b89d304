from __future__ import annotations

import random

import pytest

from tests import model
from wayfleet.config import Limits, Sizing, Zone
from wayfleet.operators import geofence, motion
from wayfleet.operators.track import Track
from wayfleet.plans.live import LiveAnalysis

close = pytest.approx


@pytest.fixture(scope="module")
def fixes():
    return model.random_fixes(21, 25, 40, hot=120)


@pytest.fixture(scope="module", params=[10**6, 11], ids=["whole", "sliced"])
def analysis(spark, fixes, request):
    rows = model.frame(spark, fixes)
    return LiveAnalysis(rows, sizing=Sizing(slice_rows=request.param, max_slices=1000))


def test_active(analysis, fixes):
    want = model.live(fixes)
    rows = analysis.active().collect()
    assert len(rows) == len(want)
    for r in rows:
        found = want[(r.taxi_id, r.seq)]
        assert r.distance_to_forbidden_city == close(found["away"])
        assert r.is_violated == found["violated"]


def test_speeds(analysis, fixes):
    want = {k: v for k, v in model.live(fixes).items() if "step" in v}
    rows = analysis.speeds().collect()
    assert len(rows) == len(want) > 100
    for r in rows:
        found = want[(r.taxi_id, r.seq)]
        assert r.segment_km == close(found["step"], abs=1e-9)
        assert r.speed == close(found["speed"], abs=1e-9)
        assert r.is_speeding == found["speeding"]


def test_averages(analysis, fixes):
    want = model.live(fixes)
    rows = analysis.averages().collect()
    assert len(rows) == len(want)
    for r in rows:
        found = want[(r.taxi_id, r.seq)]
        assert r.average_speed == close(found["average"], abs=1e-9)
        assert r.taxi_distance == close(found["total"], abs=1e-9)
        assert r.elapsed_seconds == close(found["spent"], abs=1e-9)


def test_fleet(analysis, fixes):
    want = model.fleet(fixes)
    rows = analysis.metrics().collect()
    assert {(r.taxi_id, r.seq): close(r.total_distance, rel=1e-9) for r in rows} == want
    total = motion.fleet_total(analysis.segments()).first().total_distance
    assert total == close(max(want.values()))


def test_written_outputs(analysis, fixes, tmp_path, spark):
    if not analysis.track.sliced:
        pytest.skip("once is enough")
    analysis.write_outputs(str(tmp_path))
    want = model.live(fixes)
    counts = {
        name: spark.read.parquet(f"{tmp_path}/{name}").count()
        for name in ("active_taxi", "over_speeding", "avg_speed", "metrics", "ended_taxi")
    }
    segments = sum("step" in v for v in want.values())
    assert counts == {
        "active_taxi": len(want), "avg_speed": len(want), "ended_taxi": 0,
        "over_speeding": segments, "metrics": segments,
    }


def test_totals_per_taxi(analysis, fixes):
    last = {}
    want = model.live(fixes)
    for taxi, rows in model.ordered(fixes).items():
        for row in rows:
            if (taxi, row[4]) in want:
                last[taxi] = want[(taxi, row[4])]
    got = {r.taxi_id: r for r in motion.taxi_totals(analysis.segments()).collect()}
    assert got.keys() == last.keys()
    for taxi, found in last.items():
        assert got[taxi].taxi_distance == close(found["total"], abs=1e-9)
        assert got[taxi].average_speed == close(found["average"], abs=1e-9)


def test_speed_history_pages(analysis, fixes):
    want: dict = {}
    live = model.live(fixes)
    for taxi, rows in model.ordered(fixes).items():
        for row in rows:
            if "speed" in live.get((taxi, row[4]), {}):
                want.setdefault(taxi, []).append(live[(taxi, row[4])]["speed"])
    pages = motion.speed_history(analysis.segments(), analysis.track, page=10).collect()
    got: dict = {}
    for r in sorted(pages, key=lambda r: (r.taxi_id, r.page)):
        assert len(r.speeds) <= 10 and r.page == len(got.get(r.taxi_id, [])) // 10
        got.setdefault(r.taxi_id, []).extend(r.speeds)
    assert got.keys() == want.keys()
    for taxi in want:
        assert got[taxi] == close(want[taxi], abs=1e-9)


def test_single_fix_and_return_to_the_zone(spark):
    fixes = [
        model.near(1, 0, 0, 1),
        # out of the zone and back: one straight segment
        model.near(2, 0, 14, 1), model.near(2, 600, 16, 2), model.near(2, 1200, 13, 3),
    ]
    analysis = LiveAnalysis(model.frame(spark, fixes))
    averages = {(r.taxi_id, r.seq): r.average_speed for r in analysis.averages().collect()}
    assert averages[(1, 1)] == 0
    (segment,) = analysis.speeds().collect()
    assert (segment.taxi_id, segment.seq, segment.seconds) == (2, 3, 1200)
    assert segment.segment_km == close(1.0, rel=1e-2)


def test_limits_are_strict(spark):
    fixes = [model.near(1, 0, 0, 1), model.near(1, 60, 1, 2)]
    places = [(f[3], f[2]) for f in fixes]
    rows = model.frame(spark, fixes, 1)
    away = geofence.inside_zone(rows).filter("seq = 2").first().distance_to_forbidden_city

    def flags(warn, radius):
        zone = Zone(warn_km=warn, radius_km=radius)
        found = geofence.inside_zone(rows, zone).filter("seq = 2").collect()
        return [r.is_violated for r in found]

    assert flags(away, 15) == [0]
    assert flags(away - 1e-9, away) == [1]
    assert flags(0, away - 1e-9) == []
    speed = model.km(*places) / 60 * 3600
    track = Track.of(rows)

    def speeding(limit):
        segments = motion.with_segments(rows, track, Limits(speeding_kmh=limit))
        return motion.segments_only(segments).first().is_speeding

    assert speeding(speed + 1e-9) == 0 and speeding(speed - 1e-9) == 1


@pytest.mark.parametrize(
    "zone",
    [Zone(), Zone(latitude=89.95, longitude=10), Zone(latitude=0, longitude=179.99),
     Zone(latitude=-60, longitude=-45, radius_km=500)],
)
def test_box_loses_nothing(spark, zone):
    """Distances decide; the box before them only saves work.  Wrapped
    coordinates mean the same place."""
    rng = random.Random(5)
    fixes = []
    for i in range(3000):
        lat = zone.latitude + rng.uniform(-1, 1) * zone.radius_km / 100
        lon = zone.longitude + rng.uniform(-2, 2) * zone.radius_km / 50
        lon += rng.choice([0, 0, 0, 360, -360])
        fixes.append(model.fix(1, i, lat, lon, i))
    rows = model.frame(spark, fixes)
    want = {
        f[4] for f in fixes
        if model.km((f[3], f[2]), (zone.latitude, zone.longitude)) <= zone.radius_km
    }
    got = {r.seq for r in geofence.inside_zone(rows, zone).select("seq").collect()}
    assert got == want and want
