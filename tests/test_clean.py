from __future__ import annotations

import pytest

from tests import model
from wayfleet.config import Limits, Sizing
from wayfleet.operators import clean
from wayfleet.operators import track as track_module
from wayfleet.operators.track import Track

SMALL = Sizing(slice_rows=7, max_slices=1000)


def verdicts(rows):
    return {
        (r.taxi_id, r.seq, r.is_trip_end): r.reject_reason for r in rows.collect()
    }


def screen(spark, fixes, **kwargs):
    return verdicts(clean.screen_fixes(model.frame(spark, fixes), **kwargs))


def test_edge_cases(spark):
    f = model.near
    fixes = [
        # 1: a single fix
        f(1, 0, 0, 1),
        # 2: a repeated time at another point
        f(2, 0, 0, 1), f(2, 0, 1, 2), f(2, 60, 1, 3),
        # 3: a far jump, then a normal fix near the first
        f(3, 0, 0, 1), f(3, 10, 50, 2), f(3, 20, 0.1, 3),
        # 4: two far fixes close to each other, then a normal one
        f(4, 0, 0, 1), f(4, 10, 50, 2), f(4, 20, 50.1, 3), f(4, 30, 0.2, 4),
        # 5: an outlier that becomes reachable when enough time has passed
        f(5, 0, 0, 1), f(5, 10, 50, 2), f(5, 700, 50, 3), f(5, 710, 50.1, 4),
    ]
    got = screen(spark, fixes)
    fast, repeat = "impossible_speed", "duplicate_time"
    assert got == {
        (1, 1, False): None,
        (2, 1, False): None, (2, 2, False): repeat, (2, 3, False): None,
        (3, 1, False): None, (3, 2, False): fast, (3, 3, False): None,
        (4, 1, False): None, (4, 2, False): fast, (4, 3, False): fast, (4, 4, False): None,
        (5, 1, False): None, (5, 2, False): fast, (5, 3, False): None, (5, 4, False): None,
    }


def test_speed_at_the_limit_passes(spark):
    fixes = [model.near(1, 0, 0, 1), model.near(1, 60, 4, 2)]
    speed = model.km(*[(f[3], f[2]) for f in fixes]) / 60 * 3600
    at_limit = screen(spark, fixes, limits=Limits(max_speed_kmh=speed * (1 + 1e-12)))
    below = screen(spark, fixes, limits=Limits(max_speed_kmh=speed * (1 - 1e-9)))
    assert at_limit[(1, 2, False)] is None
    assert below[(1, 2, False)] == "impossible_speed"


def test_markers(spark):
    f, m = model.near, model.marker
    fixes = [
        f(1, 0, 0, 1), f(1, 60, 0.5, 2), m(1, 60, 2), f(1, 120, 1, 3),
        # the last fix of the trip is itself rejected
        f(2, 0, 0, 1), f(2, 10, 90, 2), m(2, 10, 2), f(2, 70, 0.5, 3),
    ]
    intent = screen(spark, fixes)
    assert all(intent[(t, 2, True)] is None for t in (1, 2))
    assert intent[(1, 3, False)] is None and intent[(2, 3, False)] is None
    wired = screen(spark, fixes, trip_end="as_wired")
    assert wired[(1, 2, True)] is None
    # Compared with the accepted marker, the next fix is too far away.
    assert wired[(1, 3, False)] == "impossible_speed"
    assert wired[(2, 2, True)] == "impossible_speed"
    assert wired[(2, 3, False)] is None
    with pytest.raises(ValueError):
        screen(spark, fixes, trip_end="other")


@pytest.mark.parametrize("mode", ["intent", "as_wired"])
def test_fold_equals_model(spark, mode):
    fixes = model.random_fixes(1, 150, 40, markers=True)
    assert screen(spark, fixes, trip_end=mode) == model.screen(fixes, trip_end=mode)


def test_small_arrow_batches(spark):
    """Rejections that run across batch borders."""
    fixes = model.random_fixes(2, 60, 60)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    try:
        for size in ("1", "3"):
            spark.conf.set(name, size)
            assert screen(spark, fixes) == model.screen(fixes)
    finally:
        spark.conf.set(name, before)


@pytest.mark.parametrize("seed", [3, 4, 5])
def test_sliced_history_equals_model(spark, seed):
    """One vehicle holds a third of the rows, shared by two far apart vehicles,
    so that a slice's start decides which of them it follows."""
    fixes = model.random_fixes(seed, 12, 30, hot=150, markers=True)
    rows = model.frame(spark, fixes)
    track = Track.of(rows, sizing=SMALL)
    assert track.sliced and dict(track.slices)[(0,)] > 10
    got = verdicts(clean.screen_fixes(rows, track))
    assert got == model.screen(fixes)


def test_rounds_do_not_grow_with_slices(spark, monkeypatch):
    """A history that starts at an outlier and keeps to such outliers: what a
    slice follows depends on all slices before it."""
    fixes = [
        model.near(1, 10 * i, 0.01 * i, i, 400 if i % 5 == 0 else 0) for i in range(300)
    ]
    rows = model.frame(spark, fixes)
    track = Track.of(rows, sizing=Sizing(slice_rows=12, max_slices=1000))
    rounds = []
    summaries = clean._summaries

    def counted(*args):
        rounds.append(1)
        return summaries(*args)

    monkeypatch.setattr(clean, "_summaries", counted)
    monkeypatch.setattr(clean, "_HEAD", 1)
    got = verdicts(clean.screen_fixes(rows, track))
    assert got == model.screen(fixes)
    assert dict(track.slices)[(1,)] >= 20 and len(rounds) <= 4


def test_sliced_as_wired(spark):
    fixes = model.random_fixes(6, 8, 40, hot=80, markers=True)
    rows = model.frame(spark, fixes)
    got = clean.screen_fixes(rows, Track.of(rows, sizing=SMALL), trip_end="as_wired")
    assert verdicts(got) == model.screen(fixes, trip_end="as_wired")


def test_slice_that_accepts_nothing(spark):
    """All rows after the first are out of reach, slice after slice."""
    fixes = [model.near(1, 0, 0, 1)] + [
        model.near(1, 10 + i, 5000, 2 + i) for i in range(60)
    ]
    rows = model.frame(spark, fixes)
    track = Track.of(rows, sizing=SMALL)
    assert track.sliced
    assert verdicts(clean.screen_fixes(rows, track)) == model.screen(fixes)


def test_clean_and_rejected_are_complements(spark):
    fixes = model.random_fixes(7, 10, 20)
    rows = model.frame(spark, fixes)
    kept, dropped = clean.clean_fixes(rows), clean.rejected_fixes(rows)
    assert kept.columns == rows.columns
    assert kept.count() + dropped.count() == len(fixes)
    assert kept.select("seq").intersect(dropped.select("seq")).count() == 0


def test_slices_stay_out_of_the_driver(spark, monkeypatch):
    """Cuts and starts of many slices stay in Spark: the driver collects
    single rows only."""
    fixes = model.random_fixes(8, 40, 60)
    rows = model.frame(spark, fixes).cache()
    monkeypatch.setattr(track_module, "_FEW_CUTS", 0)

    collect = type(rows).collect

    def one_row(self):
        found = collect(self)
        assert len(found) <= 1, "rows of slices in the driver"
        return found

    monkeypatch.setattr(type(rows), "collect", one_row)
    track = Track.of(rows, sizing=SMALL)
    screened = clean.screen_fixes(rows, track)
    monkeypatch.undo()
    assert track.sliced and verdicts(screened) == model.screen(fixes)
