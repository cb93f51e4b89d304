from __future__ import annotations

from math import inf

import pytest

from tests import model
from wayfleet.config import Sizing
from wayfleet.operators import explore, motion, replay
from wayfleet.plans.offline import OfflineAnalysis

close = pytest.approx


@pytest.fixture(scope="module")
def raw():
    fixes = model.random_fixes(31, 15, 30, hot=60, markers=True)
    # exact copies, under other sequence numbers
    return fixes + [f[:4] + (f[4] + 10_000,) + f[5:] for f in fixes[::4]]


@pytest.fixture(scope="module", params=[10**6, 9], ids=["whole", "sliced"])
def analysis(spark, raw, request):
    return OfflineAnalysis(
        model.frame(spark, raw), sizing=Sizing(slice_rows=request.param, max_slices=1000)
    )


def distinct(raw):
    kept: dict = {}
    for f in sorted(raw, key=lambda f: f[4]):
        kept.setdefault(f[:4], f)
    return list(kept.values())


def steps(raw):
    inside = [f for f in distinct(raw) if model.km((f[3], f[2]), model.CENTRE) <= 15]
    out = []
    for taxi, rows in sorted(model.ordered(inside).items()):
        last = None
        for f in rows:
            found = {"taxi": taxi, "seq": f[4], "km": None, "speed": None}
            if last is not None:
                km, hours = model.km((last[3], last[2]), (f[3], f[2])), (f[1] - last[1]) / 3600
                found["km"] = km
                found["speed"] = km / hours if hours > 0 else (inf if km > 0 else None)
            out.append(found)
            last = f
    return out


def test_distinct_rows(analysis, raw):
    got = {(r.taxi_id, r.seq) for r in analysis.distinct_rows().collect()}
    assert got == {(f[0], f[4]) for f in distinct(raw)}


def test_repeated_times(analysis, raw):
    moving = [f for f in distinct(raw) if not f[5]]
    times = [(f[0], f[1]) for f in moving]
    want = {f[4] for f in moving if times.count((f[0], f[1])) > 1}
    repeated = analysis.repeated_times()
    assert {r.seq for r in repeated.collect()} == want and want
    counts = explore.value_counts(repeated, "taxi_id").collect()
    assert sum(r["count"] for r in counts) == len(want)
    shown = [(-r["count"], r.taxi_id) for r in counts]
    assert shown == sorted(shown)


def test_steps(analysis, raw):
    want = {(s["taxi"], s["seq"]): s for s in steps(raw)}
    rows = analysis.steps().collect()
    assert len(rows) == len(want)
    for r in rows:
        found = want[(r.taxi_id, r.seq)]
        if found["km"] is None:
            assert r.distance_between_points is None and r.speed is None
        else:
            assert r.distance_between_points == close(found["km"], abs=1e-9)
            assert r.speed == (found["speed"] and close(found["speed"], rel=1e-9))


def test_fast_and_far(analysis, raw):
    fast = {(s["taxi"], s["seq"]) for s in steps(raw) if s["speed"] and s["speed"] > 50}
    assert {(r.taxi_id, r.seq) for r in analysis.high_speed().collect()} == fast
    far = {(s["taxi"], s["seq"]) for s in steps(raw) if s["km"] and s["km"] > 15}
    assert {(r.taxi_id, r.seq) for r in analysis.abnormal_jumps().collect()} == far


def test_distance_over_time(analysis, raw):
    total, want = 0.0, {}
    for i, s in enumerate(steps(raw)):
        total += s["km"] or 0.0
        if i:
            want[(s["taxi"], s["seq"])] = total
    rows = analysis.distance_over_time().collect()
    assert {(r.taxi_id, r.seq) for r in rows} == want.keys()
    for r in rows:
        assert r.total_distance == close(want[(r.taxi_id, r.seq)], rel=1e-9)


def test_no_time_passed(spark):
    fixes = [model.near(1, 0, 0, 1), model.near(1, 0, 0.5, 2), model.near(1, 0, 0.5, 3)]
    analysis = OfflineAnalysis(model.frame(spark, fixes))
    # The third row repeats the second, so it is not even a row of its own.
    speeds = {r.seq: r.speed for r in analysis.steps().collect()}
    assert speeds == {1: None, 2: inf}
    steps = motion.with_steps(model.frame(spark, fixes), analysis.track)
    assert {r.seq: r.speed for r in steps.collect()} == {1: None, 2: inf, 3: None}
    assert [r.seq for r in motion.faster_than(steps, 50).collect()] == [2]


def test_time_slices(spark):
    fixes = [model.near(1, s, 0, s) for s in range(0, 400, 10)]
    rows = model.frame(spark, fixes)
    got = replay.time_slice(rows, "2008-02-02 13:31:00", "2008-02-02 13:32:00").collect()
    assert sorted(r.seq for r in got) == [60, 70, 80, 90, 100, 110]
    # Steps begin at 60, 120 and 180; the last one runs past the end at 200.
    got = replay.replay_slices(rows, "2008-02-02 13:31:00", "2008-02-02 13:33:20", 60)
    assert {r.seq: r.slice_id for r in got.collect()} == {
        s: (s - 60) // 60 for s in range(60, 240, 10)
    }


def test_head_and_profile(spark):
    fixes = model.random_fixes(32, 5, 10)
    rows = model.frame(spark, fixes)
    want = sorted((f[1], f[4]) for f in fixes)[:5]
    assert [r.seq for r in explore.head(rows).collect()] == [q for _, q in want]
    profile = explore.profile(rows.selectExpr("*", "if(seq > 3, seq, null) AS some"))
    by_name = {r.column_name: r for r in profile.collect()}
    assert by_name["some"].nulls == sum(f[4] <= 3 for f in fixes)
    assert by_name["ts"].column_type == "timestamp"
    assert by_name["seq"].non_null == len(fixes)
