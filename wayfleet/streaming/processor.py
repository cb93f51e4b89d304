"""The live analysis of vehicles as a stateful stream processor."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql.streaming.stateful_processor import (
    StatefulProcessor,
    StatefulProcessorHandle,
)
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfleet.config import LIMITS, ZONE, Limits, Zone
from wayfleet.functions.points import ACCEPTED, REASONS, distances_km, fold_many

OUTPUT_SCHEMA = T.StructType(
    [
        T.StructField("taxi_id", T.IntegerType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("seq", T.LongType()),
        T.StructField("is_trip_end", T.BooleanType()),
        T.StructField("reject_reason", T.StringType()),
        T.StructField("distance_to_forbidden_city", T.DoubleType()),
        T.StructField("is_violated", T.IntegerType()),
        T.StructField("segment_km", T.DoubleType()),
        T.StructField("speed", T.DoubleType()),
        T.StructField("is_speeding", T.IntegerType()),
        T.StructField("taxi_distance", T.DoubleType()),
        T.StructField("elapsed_seconds", T.DoubleType()),
        T.StructField("average_speed", T.DoubleType()),
        T.StructField("ended_trip_count", T.LongType()),
        T.StructField("is_late", T.BooleanType()),
    ]
)

# What the processor takes and gives: times are whole microseconds, which carry
# every year from 1 to 9999; pandas' own times end in 2262.
RAW_SCHEMA = T.StructType([T.StructField("us", T.LongType()) if f.name == "ts" else f for f in OUTPUT_SCHEMA])

# Fixes of a vehicle's last seconds, as one packed value: rows of a list state
# cross to Spark one at a time, which costs far more than the work on them.
_WAITING = np.dtype(
    [
        ("us", "<i8"),
        ("longitude", "<f8"),
        ("latitude", "<f8"),
        ("seq", "<i8"),
        ("is_trip_end", "?"),
    ]
)

NEVER = np.iinfo(np.int64).min // 2

# A vehicle at rest: last accepted fix, last fix inside the zone, running values;
# newest time, time up to which a timer has released, when the vehicle was last
# heard, when it is due and when it last changed (these three in milliseconds of
# processing time), number of waiting fixes.  NEVER stands for a time there is not.
_VEHICLE = np.dtype(
    [
        ("taxi_id", "<i4"),
        ("ok_lat", "<f8"),
        ("ok_lon", "<f8"),
        ("ok_us", "<i8"),
        ("in_lat", "<f8"),
        ("in_lon", "<f8"),
        ("in_us", "<i8"),
        ("km", "<f8"),
        ("seconds", "<f8"),
        ("speed_sum", "<f8"),
        ("speed_n", "<i8"),
        ("ended", "<i8"),
        ("newest", "<i8"),
        ("released", "<i8"),
        ("heard_ms", "<i8"),
        ("due_ms", "<i8"),
        ("changed_ms", "<i8"),
        ("waiting", "<i8"),
    ]
)
PROGRESS = _VEHICLE.names[1:12]
START = (None,) * 6 + (0.0, 0.0, 0.0, 0, 0)
_NEW = np.array((0, *(np.nan, np.nan, NEVER) * 2, *START[6:], *(NEVER,) * 5, 0), dtype=_VEHICLE)

# The vehicles of a bucket, packed, their waiting fixes one after another, and
# when the bucket's timer fires.
_STATE = T.StructType(
    [
        T.StructField("vehicles", T.BinaryType()),
        T.StructField("waiting", T.BinaryType()),
        T.StructField("timer_ms", T.LongType()),
    ]
)

#: Rows of a bucket that are handed on at once.
_ROWS_AT_ONCE = 50_000


class Standing(NamedTuple):
    """Where a vehicle stands; its fields as in ``_VEHICLE``, None for NEVER in
    ``heard`` and ``due`` and for fixes there are not."""

    progress: tuple = START
    newest: int = NEVER
    released: int = NEVER
    heard: int | None = None
    due: int | None = None
    waiting: np.ndarray = np.empty(0, dtype=_WAITING)


def _known(us: int) -> int | None:
    return None if us == NEVER else us


class Bucket:
    """The vehicles that share a state value, in the order of their numbers."""

    def __init__(self, vehicles: np.ndarray, waiting: np.ndarray, timer: int | None = None):
        self.vehicles, self.waiting, self.timer = vehicles, waiting, timer
        self._ends = np.cumsum(vehicles["waiting"])

    @classmethod
    def unpack(cls, stored: tuple | None) -> Bucket:
        if stored is None:
            return cls(np.empty(0, dtype=_VEHICLE), np.empty(0, dtype=_WAITING))
        vehicles, waiting, timer = stored
        return cls(np.frombuffer(bytes(vehicles), dtype=_VEHICLE), np.frombuffer(bytes(waiting), dtype=_WAITING), timer)

    def pack(self) -> tuple:
        return self.vehicles.tobytes(), self.waiting.tobytes(), self.timer

    def standing(self, taxi: int) -> Standing:
        at = int(np.searchsorted(self.vehicles["taxi_id"], taxi))
        if at == len(self.vehicles) or self.vehicles["taxi_id"][at] != taxi:
            return Standing()
        _, *progress, newest, released, heard, due, _, size = self.vehicles[at].item()
        for first in (0, 3):
            if progress[first + 2] == NEVER:
                progress[first : first + 3] = (None,) * 3
        end = int(self._ends[at])
        return Standing(tuple(progress), newest, released, _known(heard), _known(due), self.waiting[end - size : end])

    def due(self, now: int) -> list[int]:
        """Vehicles whose time has come."""
        due = self.vehicles["due_ms"]
        return self.vehicles["taxi_id"][(due != NEVER) & (due <= now)].tolist()

    def first_due(self) -> int | None:
        due = self.vehicles["due_ms"]
        due = due[due != NEVER]
        return int(due.min()) if len(due) else None

    def of(self, taxis: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """These vehicles (ascending), new ones as they begin, and their waiting fixes."""
        vehicles = np.full(len(taxis), _NEW)
        vehicles["taxi_id"] = taxis
        mine = np.isin(self.vehicles["taxi_id"], taxis)
        vehicles[np.searchsorted(taxis, self.vehicles["taxi_id"][mine])] = self.vehicles[mine]
        return vehicles, self.waiting[np.repeat(mine, self.vehicles["waiting"])]

    def without(self, taxis: Sequence[int]) -> Bucket:
        stay = ~np.isin(self.vehicles["taxi_id"], taxis)
        waiting = self.waiting[np.repeat(stay, self.vehicles["waiting"])]
        return Bucket(self.vehicles[stay], waiting, self.timer)

    def replaced(self, vehicles: np.ndarray, waiting: np.ndarray) -> Bucket:
        """The bucket with these vehicles and their waiting fixes, new or instead
        of what it had."""
        rest = self.without(vehicles["taxi_id"])
        vehicles = np.concatenate([rest.vehicles, vehicles])
        waiting = np.concatenate([rest.waiting, waiting])
        order = np.argsort(vehicles["taxi_id"], kind="stable")
        # Waiting fixes follow their vehicles.
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        moved = np.argsort(np.repeat(place, vehicles["waiting"]), kind="stable")
        return Bucket(vehicles[order], waiting[moved], self.timer)

    def changed(self, standings: dict[int, Standing], now: int | None) -> Bucket:
        """The bucket with new standings of some of its vehicles, or more of them."""
        new = [
            (
                taxi,
                *(NEVER if x is None and name.endswith("_us") else x for name, x in zip(PROGRESS, s.progress)),
                s.newest,
                s.released,
                *(NEVER if x is None else x for x in (s.heard, s.due, now)),
                len(s.waiting),
            )
            for taxi, s in standings.items()
        ]
        waiting = np.concatenate([np.empty(0, dtype=_WAITING), *(s.waiting for s in standings.values())])
        return self.replaced(np.array(new, dtype=_VEHICLE), waiting)


def in_turn(
    fixes: np.ndarray, newest: int, lateness: int, released: int = NEVER
) -> tuple[np.ndarray, np.ndarray, int]:
    """The turn of each arriving fix, whether it is late, and the newest time.

    ``fixes`` are in the order of their arrival.  A fix waits until the vehicle
    is ``lateness`` ahead of it; its turn is its time.  One that arrives when
    its time has passed already, or was ``released`` by a timer, is late: its
    turn is what had passed by then.  Without timers, turns depend on the
    arrivals alone, not on how they fall into batches."""
    whose = np.zeros(len(fixes), dtype=np.int64)
    turn, late, newest = in_turns(fixes, whose, np.array([newest]), lateness, np.array([released]))
    return turn, late, int(newest[0])


def in_turns(
    fixes: np.ndarray, whose: np.ndarray, newest: np.ndarray, lateness: int, released: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same for many vehicles at once; ``whose`` has the vehicle of each
    fix, ascending, as an index of ``newest`` and ``released``."""
    vehicles = np.arange(len(newest))
    first, after = (np.searchsorted(whose, vehicles, side) for side in ("left", "right"))
    # Running greatest times, begun anew by each vehicle's newest: ranks of
    # times, each vehicle's above those of the one before.
    times, rank = np.unique(np.insert(fixes["us"], first, newest), return_inverse=True)
    lowest = np.insert(whose, first, vehicles) * len(times)
    ahead = times[np.maximum.accumulate(lowest + rank) - lowest]
    passed = np.maximum(ahead[np.arange(len(fixes)) + whose] - lateness, released[whose] + 1)
    late = fixes["us"] < passed
    return np.where(late, passed, fixes["us"]), late, ahead[after + vehicles]


def milliseconds(duration: str | None) -> int | None:
    return None if duration is None else int(pd.Timedelta(duration) / pd.Timedelta(milliseconds=1))


class VehicleProcessor(StatefulProcessor):
    """Puts each vehicle's fixes in order of time and handles them: cleaning,
    zone test, segments, running values, trip counts.

    All keyed steps share the key, so they share one shuffle.  A call to Spark's
    state costs far more than a vehicle's few rows, so the key is a bucket of
    vehicles (``bucket_of``) with one packed state value: for each vehicle its
    running values and the fixes of its last ``lateness``.  Calls per batch are
    bounded by the number of buckets, whatever the number of vehicles.

    What a vehicle has sent decides how far it has come, so slow partitions
    and the size of a trigger change nothing and no fix is lost: late ones are
    handled when they arrive and marked.  An end of input releases what waits.

    With ``silence`` (processing time), a timer releases what a vehicle left
    behind when nothing has come from it for so long; an end of trip among it
    releases its trip ``trip_end_wait`` after the batch it came in.  Timers are
    lazy: each bucket has one, for the vehicle that is due first, which looks at
    the state when it fires and is set anew where vehicles have moved on.

    With ``forget_after`` the state of a vehicle that was silent for so long
    is dropped, at the latest when its bucket is next read; a vehicle that comes
    back later begins anew.
    """

    def __init__(
        self,
        zone: Zone = ZONE,
        limits: Limits = LIMITS,
        trip_end: str = "intent",
        silence: str | None = None,
        trip_end_wait: str = "0 seconds",
        forget_after: str | None = None,
    ):
        self._zone, self._limits, self._trip_end = zone, limits, trip_end
        self._lateness = int(pd.Timedelta(limits.lateness) / pd.Timedelta(microseconds=1))
        self._silence, self._trip_end_wait = milliseconds(silence), milliseconds(trip_end_wait)
        self._forget_after = milliseconds(forget_after)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._state = handle.getValueState("bucket", _STATE, self._forget_after)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        """Go on from where a batch analysis ended (``start.starting_state``)."""
        now = self._now(timerValues)

        def column(name: str) -> list:
            # By column: a row of mixed types would turn whole numbers into floats.
            kind = int if _VEHICLE.fields[name][0].kind == "i" else float
            return [None if pd.isna(x) else kind(x) for x in initialState[name]]

        progress = zip(*map(column, PROGRESS))
        found = zip(column("taxi_id"), progress, column("newest"))
        standings = {taxi: Standing(values, NEVER if newest is None else newest) for taxi, values, newest in found}
        self._store(self._load(now).changed(standings, now), now)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        arrived, senders, flushed = [np.empty(0, dtype=_WAITING)], [], []
        for batch in rows:
            ends, taxis = batch["is_flush"].to_numpy(dtype=bool), batch["taxi_id"].to_numpy(dtype=np.int32)
            flushed.append(taxis[ends])
            arrived.append(pack(batch[~ends] if ends.any() else batch))
            senders.append(taxis[~ends])
        fixes, taxis, flushed = np.concatenate(arrived), np.concatenate(senders), np.concatenate(flushed)
        order = np.lexsort((fixes["seq"], taxis))
        own = np.union1d(taxis, flushed)
        now = self._now(timerValues)
        bucket = self._load(now)
        vehicles, waiting = bucket.of(own)
        whose = np.searchsorted(own, taxis[order])
        ready = self._arrive(vehicles, waiting, fixes[order], whose, np.isin(own, flushed), now)
        yield from self._handled(bucket, vehicles, *ready, now)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()
        bucket = self._load(now)
        vehicles, waiting = bucket.of(np.array(bucket.due(now), dtype=np.int32))
        yield from self._handled(bucket, vehicles, *self._expire(vehicles, waiting, now), now)

    def _arrive(
        self,
        vehicles: np.ndarray,
        waiting: np.ndarray,
        fixes: np.ndarray,
        whose: np.ndarray,
        flush: np.ndarray,
        now: int | None,
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Fixes whose turn has come, whose they are, which of them are late, and
        those that wait.  ``vehicles`` get their standing after, but for their
        progress."""
        turn, late, newest = in_turns(fixes, whose, vehicles["newest"], self._lateness, vehicles["released"])
        fixes = np.concatenate([waiting, fixes])
        whose = np.r_[np.repeat(np.arange(len(vehicles)), vehicles["waiting"]), whose]
        turn = np.r_[waiting["us"], turn]
        late = np.r_[np.zeros(len(waiting), dtype=bool), late]
        arrival = np.arange(len(fixes))
        # Late fixes come before those whose turn is at the same time, as they
        # arrived; others by time, markers last, then by number.
        order = np.lexsort(
            (
                np.where(late, arrival, fixes["seq"]),
                np.where(late, False, fixes["is_trip_end"]),
                ~late,
                turn,
                whose,
            )
        )
        fixes, whose, turn, late = fixes[order], whose[order], turn[order], late[order]
        ready = late | flush[whose] | (turn < newest[whose] - self._lateness)
        kept = fixes[~ready]
        vehicles["newest"] = newest
        if self._silence is not None:
            vehicles["heard_ms"] = now
            self._wait(vehicles, kept, whose[~ready], now)
        vehicles["waiting"] = np.bincount(whose[~ready], minlength=len(vehicles))
        return fixes[ready], whose[ready], late[ready], kept

    def _expire(
        self, vehicles: np.ndarray, waiting: np.ndarray, now: int
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The same when vehicles are due."""
        whose = np.repeat(np.arange(len(vehicles)), vehicles["waiting"])
        heard = vehicles["heard_ms"]
        silent = (heard != NEVER) & (now >= heard + self._silence)
        ends = waiting["is_trip_end"]
        until = np.full(len(vehicles), NEVER)
        np.maximum.at(until, whose[ends], waiting["us"][ends])
        ready = silent[whose] | (waiting["us"] <= until[whose])
        released = vehicles["released"].copy()
        np.maximum.at(released, whose[ready], waiting["us"][ready])
        vehicles["released"], vehicles["due_ms"] = released, NEVER
        self._wait(vehicles, waiting[~ready], whose[~ready], now)
        vehicles["waiting"] = np.bincount(whose[~ready], minlength=len(vehicles))
        return waiting[ready], whose[ready], np.zeros(int(ready.sum()), dtype=bool), waiting[~ready]

    def _wait(self, vehicles: np.ndarray, kept: np.ndarray, whose: np.ndarray, now: int) -> None:
        """Set when the vehicles' waiting fixes must be looked at."""
        size = len(vehicles)
        ended = np.bincount(whose[kept["is_trip_end"]], minlength=size) > 0
        heard, due = vehicles["heard_ms"], vehicles["due_ms"]
        wanted = np.where(ended, now + self._trip_end_wait, np.where(heard == NEVER, now, heard) + self._silence)
        wanted = np.maximum(wanted, now + 1)
        due = np.where((now < due) & (due <= wanted), due, wanted)
        vehicles["due_ms"] = np.where(np.bincount(whose, minlength=size) > 0, due, NEVER)

    def _handled(
        self,
        bucket: Bucket,
        vehicles: np.ndarray,
        fixes: np.ndarray,
        whose: np.ndarray,
        late: np.ndarray,
        kept: np.ndarray,
        now: int | None,
    ) -> Iterator[pd.DataFrame]:
        """Rows of the fixes whose turn has come, and the vehicles' state after."""
        if len(fixes):
            columns = advance_all(fixes, whose, vehicles, self._zone, self._limits, self._trip_end)
            columns |= {"taxi_id": vehicles["taxi_id"][whose], "is_late": late}
            rows = pd.DataFrame({name: columns[name] for name in RAW_SCHEMA.fieldNames()}, copy=False)
            for at in range(0, len(rows), _ROWS_AT_ONCE):
                yield rows.iloc[at : at + _ROWS_AT_ONCE]
        if len(vehicles):
            vehicles["changed_ms"] = NEVER if now is None else now
            bucket = bucket.replaced(vehicles, kept)
        self._store(bucket, now)

    def _now(self, timerValues) -> int | None:
        timed = self._silence is not None or self._forget_after is not None
        return timerValues.getCurrentProcessingTimeInMs() if timed else None

    def _load(self, now: int | None) -> Bucket:
        bucket = Bucket.unpack(self._state.get())
        if self._forget_after is not None:
            old = bucket.vehicles["changed_ms"] + self._forget_after <= now
            if old.any():
                bucket = bucket.without(bucket.vehicles["taxi_id"][old].tolist())
        return bucket

    def _store(self, bucket: Bucket, now: int | None) -> None:
        first, set_to = bucket.first_due(), bucket.timer
        if set_to is not None and set_to <= now:
            set_to = None
        if first is not None and (set_to is None or first < set_to):
            set_to = max(first, now + 1)
            self._handle.registerTimer(set_to)
        bucket.timer = set_to
        self._state.update(bucket.pack())

    def close(self) -> None:
        pass


def bucket_of(taxi_id: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(taxi_id), F.lit(buckets)).cast("int")


def pack(batch: pd.DataFrame) -> np.ndarray:
    fixes = np.empty(len(batch), dtype=_WAITING)
    for name in ("us", "longitude", "latitude", "seq", "is_trip_end"):
        fixes[name] = batch[name].to_numpy()
    return fixes


def advance(
    fixes: np.ndarray, state: tuple, zone: Zone, limits: Limits, trip_end: str
) -> tuple[dict, tuple]:
    """Handle ordered fixes of one vehicle: output columns and the state after."""
    vehicles = Bucket.unpack(None).changed({0: Standing(state)}, None).vehicles
    columns = advance_all(fixes, np.zeros(len(fixes), dtype=np.int64), vehicles, zone, limits, trip_end)
    return columns, Bucket(vehicles, fixes[:0]).standing(0).progress


def advance_all(
    fixes: np.ndarray, whose: np.ndarray, vehicles: np.ndarray, zone: Zone, limits: Limits, trip_end: str
) -> dict:
    """Handle fixes of many vehicles: output columns.  ``whose`` has the vehicle
    of each fix, ascending, as an index of ``vehicles``, which get their
    progress after; each vehicle's fixes are in order.

    Works on whole columns; NaN stands for NULL in the output.
    """
    lat, lon, us = fixes["latitude"], fixes["longitude"], fixes["us"]
    marker = fixes["is_trip_end"]
    size = len(fixes)

    # Markers pass untouched, or are compared like any other fix.
    compared = np.flatnonzero(~marker) if trip_end == "intent" else np.arange(size)
    codes = np.zeros(size, dtype=np.int8)
    codes[compared] = fold_many(
        lat[compared],
        lon[compared],
        us[compared],
        marker[compared],
        whose[compared],
        (vehicles["ok_lat"], vehicles["ok_lon"], vehicles["ok_us"]),
        vehicles["ok_us"] != NEVER,
        limits.max_speed_kmh,
    )

    to_centre = distances_km(lat, lon, zone.latitude, zone.longitude)
    inside = (codes == ACCEPTED) & (to_centre <= zone.radius_km)
    at, own = np.flatnonzero(inside), whose[inside]

    def blank() -> np.ndarray:
        return np.full(size, np.nan)

    out = {
        "us": us,
        "longitude": lon,
        "latitude": lat,
        "seq": fixes["seq"],
        "is_trip_end": marker,
        "reject_reason": np.array([None, *REASONS.values()], dtype=object)[codes],
        "distance_to_forbidden_city": np.where(inside, to_centre, np.nan),
        **{
            name: blank()
            for name in (
                "is_violated",
                "segment_km",
                "speed",
                "is_speeding",
                "taxi_distance",
                "elapsed_seconds",
                "average_speed",
                "ended_trip_count",
            )
        },
    }
    if len(at):
        first = np.diff(own, prepend=-1) != 0
        before = {name: np.r_[column[at[:1]], column[at[:-1]]] for name, column in (("lat", lat), ("lon", lon), ("us", us))}
        for name, column in before.items():
            column[first] = vehicles[f"in_{name}"][own[first]]
        has_previous = before["us"] != NEVER
        out["is_violated"][at] = to_centre[at] > zone.warn_km
        step = np.where(has_previous, distances_km(before["lat"], before["lon"], lat[at], lon[at]), np.nan)
        passed = (us[at] - np.where(has_previous, before["us"], us[at])) / 1e6
        speed = np.divide(step, passed, out=np.zeros(len(at)), where=passed > 0) * 3600
        out["segment_km"][at] = step
        out["speed"][at] = np.where(has_previous, speed, np.nan)
        out["is_speeding"][at] = np.where(has_previous, speed > limits.speeding_kmh, np.nan)

        begin = np.flatnonzero(first)
        run_km = _running(np.where(has_previous, step, 0.0), begin, vehicles["km"][own])
        run_seconds = _running(passed, begin, vehicles["seconds"][own])
        run_sum = _running(speed, begin, vehicles["speed_sum"][own])
        run_n = _running(has_previous.astype(np.int64), begin, vehicles["speed_n"][own])
        out["taxi_distance"][at] = run_km
        out["elapsed_seconds"][at] = run_seconds
        out["average_speed"][at] = run_sum / np.maximum(run_n, 1)
        last = _lasts(own)
        after = {"in_lat": lat[at], "in_lon": lon[at], "in_us": us[at]}
        after |= {"km": run_km, "seconds": run_seconds, "speed_sum": run_sum, "speed_n": run_n}
        for name, column in after.items():
            vehicles[name][own[last]] = column[last]
    # As wired, only markers inside the zone would count, and none can be.
    counted = np.flatnonzero(marker if trip_end == "intent" else marker & inside)
    own = whose[counted]
    begin = np.flatnonzero(np.diff(own, prepend=-1))
    ended = _running(np.ones(len(own), dtype=np.int64), begin, vehicles["ended"][own])
    out["ended_trip_count"][counted] = ended
    last = _lasts(own)
    vehicles["ended"][own[last]] = ended[last]

    accepted = compared[codes[compared] == ACCEPTED]
    accepted = accepted[_lasts(whose[accepted])]
    for name, column in (("ok_lat", lat), ("ok_lon", lon), ("ok_us", us)):
        vehicles[name][whose[accepted]] = column[accepted]
    return out


def _lasts(whose: np.ndarray) -> np.ndarray:
    """Where each vehicle's last row is."""
    return np.flatnonzero(np.diff(whose, append=-1))


def _running(values: np.ndarray, begin: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Running sums of each vehicle's values, which begin at ``begin``, after
    what it had.  Summed by vehicle: a sum over all would round otherwise."""
    sums = np.empty_like(values)
    for one, other in zip(begin.tolist(), [*begin[1:].tolist(), len(values)]):
        np.add.accumulate(values[one:other], out=sums[one:other])
    return sums + before
