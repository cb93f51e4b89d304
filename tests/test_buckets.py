"""Work of a micro-batch per bucket of vehicles, not per vehicle; messages parsed
once; the router without state of Spark's."""

from __future__ import annotations

import json

import numpy as np
import pandas as pd

from tests.test_router import average, line, route, rows
from wayfleet.config import LIMITS, ZONE
from wayfleet.functions.points import fold, fold_many
from wayfleet.sources import messages
from wayfleet.streaming import processor as processing
from wayfleet.streaming.processor import _WAITING, START, Bucket, Standing, VehicleProcessor, advance

SECOND = 1_000_000


class Handle:
    """State of one bucket, which counts how often it is asked."""

    def __init__(self):
        self.value, self.calls, self.timers = None, 0, []

    def getValueState(self, *_):
        return self

    def get(self):
        self.calls += 1
        return self.value

    def update(self, value):
        self.calls += 1
        self.value = value

    def registerTimer(self, at):
        self.timers.append(at)


class Clock:
    def __init__(self, now):
        self.now = now

    def getCurrentProcessingTimeInMs(self):
        return self.now


def fixes(taxis, seconds, flush=False):
    found = [
        {"bucket": 0, "taxi_id": t, "longitude": 116.4 + 0.001 * (s % 3), "latitude": 39.9, "seq": 1000 * t + s,
         "is_trip_end": False, "is_flush": flush, "us": s * SECOND}
        for s in seconds for t in taxis
    ]
    return pd.DataFrame(found).astype({"taxi_id": "int32"})


def test_a_bucket_costs_two_calls_whatever_its_vehicles():
    handle, processor = Handle(), VehicleProcessor()
    processor.init(handle)
    taxis = range(50)
    got = []
    for seconds in ([30, 0, 60], [90, 120]):
        handle.calls = 0
        got += processor.handleInputRows((0,), iter([fixes(taxis, seconds)]), None)
        assert handle.calls == 2
    got += processor.handleInputRows((0,), iter([fixes(taxis, [10**6], flush=True)]), None)
    got = pd.concat(got)
    assert len(got) == 250 and not got["is_late"].any()
    for taxi in taxis:
        # Each vehicle has what it would have alone.
        own = np.array([(s * SECOND, 116.4 + 0.001 * (s % 3), 39.9, 1000 * taxi + s, False) for s in (0, 30, 60, 90, 120)], dtype=_WAITING)
        want, _ = advance(own, START, ZONE, LIMITS, "intent")
        mine = got[got["taxi_id"] == taxi]
        assert mine["seq"].tolist() == want["seq"].tolist()
        for name in ("average_speed", "taxi_distance", "speed"):
            assert np.allclose(mine[name].to_numpy(), want[name], equal_nan=True)


def test_a_buckets_vehicles_are_handled_at_once(monkeypatch):
    """Calls per batch do not grow with the vehicles."""
    calls = []

    def counted(*places):
        calls.append(len(places[0]))
        return distances(*places)

    distances = processing.distances_km
    monkeypatch.setattr(processing, "distances_km", counted)
    needed = []
    for count in (3, 60):
        calls.clear()
        processor = VehicleProcessor()
        processor.init(Handle())
        assert sum(len(x) for x in processor.handleInputRows((0,), iter([fixes(range(count), [0, 30, 60, 90])]), None)) == 3 * count
        needed.append(len(calls))
    assert needed[0] == needed[1]


def test_many_vehicles_are_folded_as_each_alone():
    rng = np.random.default_rng(8)
    for _ in range(60):
        own = rng.integers(0, 9, 12)
        whose = np.repeat(np.arange(12), own)
        size = len(whose)
        us = np.concatenate([np.sort(rng.integers(0, 60, n)) for n in own]) * 10 * SECOND
        lat, lon = 39.9 + rng.normal(0, 0.02, size), 116.4 + rng.choice([0.0, 0.0, 2.0], size)
        marker, has_last = rng.random(size) < 0.1, rng.random(12) < 0.6
        last = (39.9 + rng.normal(0, 0.02, 12), 116.4 + rng.choice([0.0, 2.0], 12), -rng.integers(0, 30, 12) * 10 * SECOND)
        got = fold_many(lat, lon, us, marker, whose, last, has_last, 300.0)
        for i in range(12):
            mine = whose == i
            start = tuple(x[i].item() for x in last) if has_last[i] else None
            want, _ = fold(lat[mine], lon[mine], us[mine], marker[mine], start, 300.0)
            assert got[mine].tolist() == want.tolist()


def test_a_bucket_keeps_its_vehicles_apart():
    def waiting(*us):
        return np.array([(u, 116.4, 39.9, u, False) for u in us], dtype=_WAITING)

    bucket = Bucket.unpack(None)
    bucket = bucket.changed({7: Standing(newest=7, waiting=waiting(70, 71)), 2: Standing(newest=2, due=5, waiting=waiting(20))}, 1)
    bucket = bucket.changed({5: Standing(newest=5), 2: Standing(newest=3, due=9, waiting=waiting(21, 22, 23))}, 2)
    bucket = Bucket.unpack(bucket.pack())
    assert bucket.vehicles["taxi_id"].tolist() == [2, 5, 7]
    assert [bucket.standing(t).waiting["us"].tolist() for t in (2, 5, 7, 8)] == [[21, 22, 23], [], [70, 71], []]
    assert [bucket.standing(t).newest for t in (2, 5, 7)] == [3, 5, 7]
    assert bucket.standing(7).progress == START and bucket.standing(7).due is None
    assert bucket.due(8) == [] and bucket.due(9) == [2] and bucket.first_due() == 9
    assert bucket.without([2]).standing(7).waiting["us"].tolist() == [70, 71]


def test_a_silent_vehicle_is_released_and_forgotten_while_another_moves():
    handle = Handle()
    processor = VehicleProcessor(silence="2 seconds", forget_after="1 minute")
    processor.init(handle)
    assert [len(x) for x in processor.handleInputRows((0,), iter([fixes([1, 2], [0, 100])]), Clock(1000))] == [2]
    assert handle.timers == [3000]
    list(processor.handleInputRows((0,), iter([fixes([2], [105])]), Clock(2500)))
    (released,) = processor.handleExpiredTimer((0,), Clock(3000), None)
    assert released["taxi_id"].tolist() == [1] and handle.timers[-1] == 4500
    (released,) = processor.handleExpiredTimer((0,), Clock(4500), None)
    assert released["seq"].tolist() == [2100, 2105]
    list(processor.handleInputRows((0,), iter([fixes([2], [200])]), Clock(63_500)))
    assert Bucket.unpack(handle.value).vehicles["taxi_id"].tolist() == [2]


def test_a_value_is_parsed_once(spark, tmp_path):
    value = json.dumps({"taxi_id": 1, "timestamp": "2008-02-02 13:30:00", "longitude": 116.4, "latitude": 39.9})
    sent = spark.createDataFrame([("1", value, 1), ("1", "no json", 2), ("1", None, 3)], "key string, value string, seq long")
    for read in (messages.stream_input, messages.complete_fixes, messages.rejected_messages):
        plan = read(sent)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json(") == 1
    assert [r.seq for r in messages.stream_input(sent).collect()] == [1]
    assert sorted((r.seq, r.reason) for r in messages.rejected_messages(sent).collect()) == [(2, "no_vehicle"), (3, "no_vehicle")]


def test_the_router_keeps_a_number_per_key(spark, tmp_path):
    (tmp_path / "topics").mkdir()
    sent = [line("avg_speed", str(t), average(t, i, 1.0), 0, 10 * i + t) for t in range(5) for i in range(4)]
    # Without a key, numbered; and without a number, twice.
    odd = [line("avg_speed", None, average(9, 1, 1.0), 0, 1)] * 2 + [line("avg_speed", "8", average(8, 1, 1.0))] * 2
    (tmp_path / "topics" / "0.json").write_text("\n".join([*sent, *sent, *odd]))
    tables, job = route(spark, tmp_path)
    assert job.lastProgress["stateOperators"] == []
    want = sorted([*((t, i) for t in range(5) for i in range(4)), (9, 1), (8, 1), (8, 1)])
    assert rows(tables, spark, "avg_speed") == want
    marks = {r.key: (r.batch, r.nth) for r in tables.history(spark, "marks").collect()}
    assert marks == {**{str(t): (0, 30 + t) for t in range(5)}, None: (0, 1)}
    # What was read before comes again in another file, with one more.
    more = line("avg_speed", "3", average(3, 5, 1.0), 1, 0)
    (tmp_path / "topics" / "1.json").write_text("\n".join([*sent, odd[0], more]))
    tables, _ = route(spark, tmp_path)
    assert rows(tables, spark, "avg_speed") == sorted([*want, (3, 5)])
