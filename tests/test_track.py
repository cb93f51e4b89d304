from __future__ import annotations

from bisect import bisect_right

import pytest
from pyspark.sql import functions as F
from pyspark.sql import Window

from tests import model
from wayfleet.config import ROW_ORDER, Sizing
from wayfleet.operators import track as tracks
from wayfleet.operators.track import SLICE, Track

ORDERS = [
    (("taxi_id",), ROW_ORDER),
    ((), ("ts", "taxi_id", "seq")),
    ((), ("taxi_id", "ts", "seq")),
]


@pytest.fixture(scope="module")
def rows(spark):
    return model.frame(spark, model.random_fixes(11, 20, 30, hot=150)).cache()


@pytest.mark.parametrize("keys,order", ORDERS)
@pytest.mark.parametrize("size", [1, 9, 10**6])
def test_same_as_plain_windows(spark, rows, keys, order, size):
    track = Track.of(rows, keys, order, Sizing(slice_rows=size, max_slices=10_000))
    value = F.col("seq") - F.col("before")
    got = track.running_sums(
        track.previous(rows, {"before": "seq", "place": "latitude"}),
        {"total": value, "nth": F.lit(1)},
    )
    window = Window.partitionBy(*keys).orderBy(*order)
    want = (
        rows.withColumn("before", F.lag("seq").over(window))
        .withColumn("place", F.lag("latitude").over(window))
        .withColumn("total", F.sum(value).over(window))
        .withColumn("nth", F.sum(F.lit(1)).over(window))
    )
    got = track.unmark(got).select(want.columns)
    assert got.exceptAll(want).count() == 0
    assert want.exceptAll(got).count() == 0


def test_slices_of_one_instant(spark):
    """A vehicle whose rows all carry one time is cut by sequence number."""
    fixes = [model.near(1, 0, 0.001 * i, i) for i in range(200)]
    rows = model.frame(spark, fixes)
    track = Track.of(rows, sizing=Sizing(slice_rows=10, max_slices=1000))
    sizes = [r["count"] for r in track.mark(rows).groupBy(SLICE).count().collect()]
    assert len(sizes) >= 15 and max(sizes) <= 20
    before = track.previous(rows, {"before": "seq"}).collect()
    assert {r.seq: r.before for r in before} == {
        i: (i - 1 if i else None) for i in range(200)
    }


def test_only_large_keys_are_sliced(spark, rows):
    track = Track.of(rows, sizing=Sizing(slice_rows=100, max_slices=1000))
    assert [key for key, _ in track.slices] == [(0,)]
    marked = track.mark(rows)
    assert marked.filter((F.col("taxi_id") != 0) & F.col(SLICE).isNotNull()).count() == 0
    assert marked.filter((F.col("taxi_id") == 0) & F.col(SLICE).isNull()).count() == 0


def test_number_of_slices_is_bounded(spark, rows):
    track = Track.of(rows, sizing=Sizing(slice_rows=1, max_slices=8))
    assert sum(n for _, n in track.slices) <= 16


@pytest.mark.parametrize("keys", [(), ("taxi_id",)])
@pytest.mark.parametrize("size", [1, 2, 7])
def test_rows_carry_pages_of_cuts(spark, rows, monkeypatch, keys, size):
    """However many cuts a key has, a row is compared with a page of them at a time."""
    monkeypatch.setattr(tracks, "_PAGE", 4)
    order = ("ts", "is_trip_end", "seq")
    some = rows.withColumn("taxi_id", F.when(F.col("seq") % 5 > 0, F.col("taxi_id")))
    track = Track.of(some, keys, order, Sizing(slice_rows=size, max_slices=10_000))
    cuts = {tuple(r[k] for k in keys): [tuple(x) for x in r["_cuts"]] for r in track.cuts.collect()}
    assert max(map(len, cuts.values())) == track.longest > 4**2
    carried = [F.max(F.size("_cuts"))]
    assert track._pages(0).agg(*carried).first()[0] <= 3 and track._pages(1).agg(*carried).first()[0] <= 3
    marked = track.mark(some.withColumn("us", F.unix_micros("ts"))).collect()
    assert len(marked) == some.count()
    for r in marked:
        of_key = cuts.get(tuple(r[k] for k in keys)) if not keys or r.taxi_id is not None else None
        assert r[SLICE] == (None if of_key is None else bisect_right(of_key, (r.us, r.is_trip_end, r.seq)))


def test_cuts_of_one_table_serve_another(spark, rows):
    track = Track.of(rows, sizing=Sizing(slice_rows=9, max_slices=1000))
    other = model.frame(spark, model.random_fixes(12, 25, 40))
    got = track.unmark(track.previous(other, {"before": "seq"}))
    window = Window.partitionBy("taxi_id").orderBy(*ROW_ORDER)
    want = other.withColumn("before", F.lag("seq").over(window))
    assert got.exceptAll(want.select(got.columns)).count() == 0


def test_empty_table(spark, rows):
    none = rows.filter(F.lit(False))
    track = Track.of(none)
    assert not track.sliced
    assert track.running_sums(none, {"n": F.lit(1)}).count() == 0
