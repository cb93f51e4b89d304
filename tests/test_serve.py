from __future__ import annotations

from tests import model
from wayfleet.config import Sizing
from wayfleet.operators import serve, trips
from wayfleet.operators.track import Track


def test_latest_and_tombstones(spark):
    f, m = model.near, model.marker
    fixes = [
        f(1, 0, 0, 1), f(1, 60, 1, 2),
        # ended: the marker follows the last fix of its second
        f(2, 0, 0, 1), f(2, 60, 1, 9), m(2, 60, 3),
        # moving again after the trip ended
        f(3, 0, 0, 1), m(3, 0, 2), f(3, 60, 2, 3),
        # ties in time go by sequence number
        f(4, 5, 0, 1), f(4, 5, 1, 2),
    ]
    latest = serve.latest_by_key(model.frame(spark, fixes))
    assert {(r.taxi_id, r.seq, r.is_trip_end) for r in latest.collect()} == {
        (1, 2, False), (2, 3, True), (3, 3, False), (4, 2, False),
    }
    assert {r.taxi_id for r in serve.without_ended(latest).collect()} == {1, 3, 4}


def test_latest_over_all_rows(spark):
    rows = model.frame(spark, model.random_fixes(51, 5, 10))
    (only,) = serve.latest_by_key(rows, [], ["seq"]).collect()
    assert only.seq == rows.count()
    assert serve.latest_by_key(rows.filter("false"), [], ["seq"]).count() == 0


def test_documents(spark):
    active = spark.createDataFrame(
        [(5, 116.5, 39.5, 3.0, 0), (6, 116.25, 39.25, 12.0, 1)],
        "taxi_id int, longitude double, latitude double, "
        "distance_to_forbidden_city double, is_violated int",
    )
    first, second = serve.document_for("active_taxi", active).orderBy("taxi_id").collect()
    assert (first.location.lon, first.location.lat) == (116.5, 39.5)
    assert first.taxi_description == "Taxi 5"
    assert first.is_violated_text == "Taxi operating within permitted area"
    assert second.is_violated_text == "Taxi has entered a restricted area"
    assert "longitude" not in first

    total = spark.createDataFrame([(12345.9,)], "total_distance double")
    document = serve.document_for("metrics", total).first()
    assert (document.total_distance, document.total_distance_string) == (12345, "12345 Km")

    speed = spark.createDataFrame([(7, 51.5)], "taxi_id int, speed double")
    assert serve.document_for("over_speeding", speed).first().taxi_description == "Taxi 7"


def test_trip_counts(spark):
    fixes = model.random_fixes(52, 6, 10, markers=True)
    fixes += [model.marker(1, 10_000 + i, 5_000 + i) for i in range(40)]
    rows = model.frame(spark, fixes)
    for size in (10**6, 4):
        track = Track.of(rows, sizing=Sizing(slice_rows=size, max_slices=1000))
        counts: dict = {}
        for r in trips.ended_running(rows, track).orderBy("ts", "seq").collect():
            counts.setdefault(r.taxi_id, []).append(r.ended_trip_count)
        assert counts == {t: [1] for t in (0, 2, 3, 4, 5)} | {1: list(range(1, 42))}
    assert {(r.taxi_id, r.ended_trip_count) for r in trips.ended_per_taxi(rows).collect()} == {
        (t, len(c)) for t, c in counts.items()
    }
    assert trips.ended_fleet(rows).first().ended_trip_count == 46
    moving, markers = trips.split_markers(rows)
    assert markers.count() == 46 and moving.count() == len(fixes) - 46
    assert trips.ended_fleet(moving).first().ended_trip_count == 0


def test_one_marker_per_file(spark):
    rows = spark.createDataFrame(
        [("a", 1, 5), ("a", 2, 3), ("b", 3, 9)], "source_file string, seq bigint, taxi_id int"
    ).selectExpr(
        "source_file", "taxi_id", "timestamp'2008-02-02 13:30:00' AS ts", "1D AS longitude",
        "2D AS latitude", "seq", "false AS is_trip_end",
    )
    both = trips.with_trip_ends(rows, ["source_file"])
    ends = both.filter("is_trip_end").collect()
    assert {(r.source_file, r.taxi_id, r.longitude, r.latitude) for r in ends} == {
        ("a", 3, -1.0, -1.0), ("b", 9, -1.0, -1.0),
    }
    assert both.count() == 5
