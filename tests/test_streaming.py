from __future__ import annotations

import json
import os
import random

import numpy as np
import pytest

from tests import model
from wayfleet.config import LIMITS, OUTPUT_TOPICS, ZONE
from wayfleet.plans.live import LiveAnalysis
from wayfleet.sinks.tables import LiveTables
from wayfleet.sources import messages
from wayfleet.streaming.job import start_live_job, start_quarantine, wait_until_silent
from wayfleet.streaming.processor import _WAITING, NEVER, OUTPUT_SCHEMA, START, advance, in_turn


def end(folder, number, *taxis):
    """A file that ends the input of vehicles."""
    path = folder / f"{number:03}.json"
    lines = [{"key": str(t), "value": json.dumps({"taxi_id": t, "flush": True}), "seq": 10**6} for t in taxis]
    path.write_text("\n".join(map(json.dumps, lines)) + "\n")
    os.utime(path, (1_700_000_000 + number, 1_700_000_000 + number))



def message(f):
    taxi, seconds, lon, lat, seq, _ = f
    value = {
        "taxi_id": taxi,
        "timestamp": model.at(seconds).strftime("%Y-%m-%d %H:%M:%S"),
        "longitude": lon,
        "latitude": lat,
    }
    return json.dumps({"key": str(taxi), "value": json.dumps(value), "seq": seq})


def send(folder, number, fixes):
    """Write one file of messages; files are read in the order of their age."""
    path = folder / f"{number:03}.json"
    path.write_text("\n".join(message(f) for f in fixes) + "\n")
    os.utime(path, (1_700_000_000 + number, 1_700_000_000 + number))


def run(spark, base, files_per_batch=1, tables=None):
    tables = tables or LiveTables(str(base / "tables"))
    job = start_live_job(
        messages.file_stream(spark, str(base / "in"), files_per_batch),
        tables,
        str(base / "checkpoint"),
        available_now=True,
    )
    job.awaitTermination()
    return tables, job


def in_disorder(fixes, files, slack):
    """Fixes in files by time, each up to ``slack`` seconds out of order."""
    rng = random.Random(9)
    moved = sorted(fixes, key=lambda f: f[1] + rng.uniform(0, slack))
    size = -(-len(moved) // files)
    return [moved[i : i + size] for i in range(0, len(moved), size)]


@pytest.fixture(scope="module")
def streamed(spark, tmp_path_factory):
    """A stream over four batches, run in two starts, and its batch twin."""
    base = tmp_path_factory.mktemp("stream")
    (base / "in").mkdir()
    fixes = model.random_fixes(61, 12, 40, markers=True)
    parts = in_disorder(fixes, 4, 9)
    for i, part in enumerate(parts[:2]):
        send(base / "in", i, part)
    run(spark, base)
    for i, part in enumerate(parts[2:]):
        send(base / "in", i + 2, part)
    end(base / "in", 9, *{f[0] for f in fixes})
    tables, job = run(spark, base)
    return fixes, tables, LiveAnalysis(model.frame(spark, fixes)), job


def table(rows, *columns):
    return sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r)
                  for r in rows.select("taxi_id", "ts", "seq", *columns).collect())


@pytest.mark.parametrize(
    "name,columns",
    [
        ("active_taxi", ["longitude", "latitude", "distance_to_forbidden_city", "is_violated"]),
        ("over_speeding", ["longitude", "latitude", "speed", "is_speeding"]),
        ("avg_speed", ["average_speed"]),
        ("metrics", ["total_distance"]),
        ("ended_taxi", ["ended_trip_count"]),
    ],
)
def test_stream_equals_batch(spark, streamed, name, columns):
    fixes, tables, batch, _ = streamed
    # The order of arrival differs between vehicles, so the fleet's distance is
    # put in order of time first.
    rows = tables.fleet_distance(spark) if name == "metrics" else tables.history(spark, name)
    got = table(rows, *columns)
    want = table(batch.outputs()[name], *columns)
    assert got == want and got


def test_rejects(spark, streamed):
    fixes, tables, _, _ = streamed
    want = {k[:2]: v for k, v in model.screen(fixes).items() if v}
    rows = tables.history(spark, "rejects").collect()
    assert {(r.taxi_id, r.seq): r.reject_reason for r in rows} == want


def test_served(spark, streamed):
    """Every trip ended, so no vehicle is active; the rest is the latest row."""
    fixes, tables, _, _ = streamed
    assert tables.latest(spark, "active_taxi").count() == 0
    live = model.live(fixes)
    last = {}
    for taxi, rows in model.ordered(fixes).items():
        for f in rows:
            if (taxi, f[4]) in live:
                last[taxi] = live[(taxi, f[4])]["average"]
    got = {r.taxi_id: r for r in tables.served(spark, "avg_speed").collect()}
    assert {t: pytest.approx(r.average_speed, abs=1e-6) for t, r in got.items()} == last
    assert got[3].taxi_description == "Taxi 3"
    total = tables.served(spark, "metrics").first()
    assert total.total_distance == int(max(model.fleet(fixes).values()))
    assert tables.served(spark, "ended_taxi").first().ended_trip_count == 1


def test_repeated_batch_changes_nothing(spark, tmp_path):
    tables = LiveTables(str(tmp_path / "tables"))
    rows = []
    for taxi in range(3):
        for i in range(4):
            rows.append((taxi, model.at(60 * i), 116.4, 39.9, 10 * taxi + i, False, None,
                         1.0, 0, 2.0 if i else None, 30.0, 0, 2.0 * i, 60.0 * i, 30.0, None, False))
    batch = spark.createDataFrame(rows, OUTPUT_SCHEMA)
    tables.write(batch, 0)
    later = batch.selectExpr(
        *[c if c != "ts" else "ts + INTERVAL 1 HOUR AS ts" for c in batch.columns]
    )
    for _ in range(2):
        tables.write(later, 1)
        history = tables.history(spark, "metrics")
        assert history.count() == 18
        assert history.agg({"total_distance": "max"}).first()[0] == 36.0
        assert tables.latest(spark, "avg_speed").count() == 3
    sent = []
    tables.publish = lambda messages: sent.extend(messages.collect())
    tables.write(later, 1)
    assert sent == []  # the batch might run again
    tables.write(batch.limit(0), 2)
    counts = {t: sum(m.topic == t for m in sent) for t in OUTPUT_TOPICS}
    assert counts == {
        "active_taxi": 12, "over_speeding": 9, "avg_speed": 12, "metrics": 9, "ended_taxi": 0,
    }
    tables.write(batch.limit(0), 3)
    tables.settle(spark)
    assert len(sent) == 42
    assert tables.history(spark, "active_taxi").count() == 24


def test_late_rows_are_handled_on_arrival_and_listed(spark, tmp_path):
    (tmp_path / "in").mkdir()
    send(tmp_path / "in", 0, [model.near(1, 0, 0, 1), model.near(1, 100, 0.1, 2)])
    send(tmp_path / "in", 1, [model.near(1, 150, 0, 5)])
    # The vehicle is at second 150: both are late, and no one else's delay counts.
    send(tmp_path / "in", 2, [model.near(1, 60, 0, 6), model.near(1, 95, 0.1, 7), model.near(2, 1, 0, 1)])
    end(tmp_path / "in", 3, 1, 2)
    tables, job = run(spark, tmp_path)
    rows = {(r.taxi_id, r.seq) for r in tables.history(spark, "active_taxi").collect()}
    assert rows == {(1, 1), (1, 2), (1, 5), (1, 6), (1, 7), (2, 1)}
    late = {(r.taxi_id, r.seq) for r in tables.history(spark, "late").collect()}
    assert late == {(1, 6), (1, 7)}
    speeds = {r.seq: r.speed for r in tables.history(spark, "over_speeding").collect()}
    assert speeds[6] == 0.0  # an older time follows: no time has passed


@pytest.mark.parametrize("files_per_batch", [1, 3, 100])
def test_trigger_size_changes_nothing(spark, tmp_path_factory, files_per_batch):
    """Files by vehicle, as a topic's partitions, one vehicle far larger."""
    base = tmp_path_factory.mktemp("trigger")
    (base / "in").mkdir()
    fixes = model.random_fixes(63, 4, 12, hot=150, markers=True)
    taxis = sorted({f[0] for f in fixes})
    for i, taxi in enumerate(taxis):
        own = [f for f in fixes if f[0] == taxi]
        send(base / "in", i, sorted(own, key=lambda f: (f[1], f[5], f[4])))
    end(base / "in", 50, *taxis)
    tables, _ = run(spark, base, files_per_batch)
    batch = LiveAnalysis(model.frame(spark, fixes)).outputs()
    for name, column in (("active_taxi", "is_violated"), ("avg_speed", "average_speed"), ("ended_taxi", "ended_trip_count")):
        assert table(tables.history(spark, name), column) == table(batch[name], column)
    assert table(tables.fleet_distance(spark), "total_distance") == table(batch["metrics"], "total_distance")
    assert tables.history(spark, "late").count() == 0


def test_turns_do_not_depend_on_batches():
    rng = np.random.default_rng(4)
    fixes = np.zeros(300, dtype=_WAITING)
    fixes["us"] = np.cumsum(rng.integers(0, 9, 300)) + rng.integers(-40, 40, 300)
    whole = in_turn(fixes, -(10**9), 20)
    for cut in (1, 77, 299):
        one = in_turn(fixes[:cut], -(10**9), 20)
        two = in_turn(fixes[cut:], one[2], 20)
        assert (np.r_[one[0], two[0]] == whole[0]).all() and (np.r_[one[1], two[1]] == whole[1]).all()
        assert two[2] == whole[2]
    assert whole[1].any() and not whole[1].all()


def test_before_the_first_batch(spark, tmp_path):
    tables = LiveTables(str(tmp_path / "none"))
    assert tables.served(spark, "ended_taxi").first().ended_trip_count == 0
    for name in ("active_taxi", "over_speeding", "avg_speed", "metrics"):
        assert tables.served(spark, name).count() == 0


@pytest.mark.parametrize("mode", ["intent", "as_wired"])
def test_state_carries_over(mode):
    """Any split of a vehicle's fixes gives the same rows as one piece."""
    fixes = [f for f in model.random_fixes(62, 1, 5, hot=80, markers=True)]
    base = int(model.START.timestamp() * 1e6)
    rows = sorted(fixes, key=lambda f: (f[1], f[5], f[4]))
    packed = np.array(
        [(base + int(f[1] * 1e6), f[2], f[3], f[4], f[5]) for f in rows], dtype=_WAITING
    )
    whole, end = advance(packed, START, ZONE, LIMITS, mode)
    for cut in (1, 7, len(rows) - 1):
        first, state = advance(packed[:cut], START, ZONE, LIMITS, mode)
        second, after = advance(packed[cut:], state, ZONE, LIMITS, mode)
        assert after == pytest.approx(end, rel=1e-12)
        for name, values in whole.items():
            joined = np.concatenate([first[name], second[name]])
            if values.dtype.kind == "f":
                assert np.allclose(joined, values, rtol=1e-12, equal_nan=True), name
            else:
                assert (joined == values).all(), name
    reasons = dict(zip(whole["seq"].tolist(), whole["reject_reason"]))
    want = model.screen(fixes, trip_end=mode)
    assert reasons == {k[1]: v for k, v in want.items()}


def test_what_a_timer_released_is_over():
    fixes = np.zeros(3, dtype=_WAITING)
    fixes["us"] = [90, 100, 101]
    turn, late, newest = in_turn(fixes, 95, 20, released=100)
    assert turn.tolist() == [101, 101, 101] and late.tolist() == [True, True, False] and newest == 101
    assert in_turn(fixes, 95, 20, NEVER)[1].tolist() == [False, False, False]


def test_silent_vehicles_and_stray_times(spark, tmp_path):
    """Ten fixes and their marker, a vehicle that just stops, and times that
    pandas cannot hold; nothing ends the input."""
    (tmp_path / "in").mkdir()
    ten = [model.near(1, 30 * i, 0.01 * (i % 2), i) for i in range(10)]
    stops = [model.near(2, 30 * i, 0.01 * (i % 2), i) for i in range(4)]
    send(tmp_path / "in", 0, [*ten, (1, 270, -1.0, -1.0, 10, True), *stops])
    with open(tmp_path / "in" / "000.json", "a") as out:
        for k, time in enumerate(("0001-01-01 00:00:00", "1600-01-01 00:00:00", "9999-12-31 00:00:00", "10000-01-01 00:00:00", "x")):
            value = {"taxi_id": 100 + k, "timestamp": time, "longitude": 116.4, "latitude": 39.9}
            out.write(json.dumps({"key": str(100 + k), "value": json.dumps(value), "seq": 1}) + "\n")
    os.utime(tmp_path / "in" / "000.json", (1_700_000_000, 1_700_000_000))
    tables, source = LiveTables(str(tmp_path / "tables")), messages.file_stream(spark, str(tmp_path / "in"), 1)
    job = start_live_job(source, tables, str(tmp_path / "checkpoint"), partitions=2, silence="1 second", forget_after="1 day")
    try:
        wait_until_silent(job, "1 second", 90)
        # The vehicle comes back: what it sends from before is late, the rest is not.
        send(tmp_path / "in", 1, [model.near(2, 60, 0.02, 20), model.near(2, 200, 0.0, 21)])
        wait_until_silent(job, "1 second", 90)
    finally:
        job.stop()
    active = {(r.taxi_id, r.seq) for r in tables.history(spark, "active_taxi").select("taxi_id", "seq").collect()}
    assert active >= {(1, i) for i in range(10)} | {(2, i) for i in range(4)} | {(2, 21), (100, 1), (101, 1), (102, 1)}
    assert [r.ended_trip_count for r in tables.history(spark, "ended_taxi").collect()] == [1]
    assert {(r.taxi_id, r.seq) for r in tables.history(spark, "late").select("taxi_id", "seq").collect()} == {(2, 20)}
    open_now = {r.taxi_id for r in tables.latest(spark, "active_taxi").select("taxi_id").collect()}
    assert 1 not in open_now and {2, 100, 101, 102} <= open_now
    start_quarantine(source, str(tmp_path / "q"), str(tmp_path / "cq"), available_now=True).awaitTermination()
    rejected = spark.read.parquet(str(tmp_path / "q"))
    assert {(r.key, r.reason) for r in rejected.collect()} == {("103", "no_time"), ("104", "no_time")}
