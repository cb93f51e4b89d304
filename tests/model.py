"""The analysis in plain Python over small lists, to compare results with."""

from __future__ import annotations

import random
from datetime import datetime, timedelta, timezone
from math import asin, cos, radians, sin, sqrt

from pyspark.sql import DataFrame, SparkSession

from wayfleet.sources.tables import FIX_SCHEMA

CENTRE = (39.9163447, 116.3971556)
START = datetime(2008, 2, 2, 13, 30, tzinfo=timezone.utc)


def at(seconds: float) -> datetime:
    return START + timedelta(seconds=seconds)


def km(a, b) -> float:
    (lat_a, lon_a), (lat_b, lon_b) = a, b
    h = sin(radians(lat_b - lat_a) / 2) ** 2
    h += cos(radians(lat_a)) * cos(radians(lat_b)) * sin(radians(lon_b - lon_a) / 2) ** 2
    return 2 * 6372.8 * asin(sqrt(h))


def fix(taxi, seconds, lat, lon, seq, end=False):
    """(taxi, seconds, longitude, latitude, seq, is_trip_end)"""
    return (taxi, seconds, lon, lat, seq, end)


def near(taxi, seconds, east_km, seq, north_km=0.0):
    """A fix some kilometres from the centre."""
    lat = CENTRE[0] + north_km / 111.226
    lon = CENTRE[1] + east_km / (111.226 * cos(radians(CENTRE[0])))
    return fix(taxi, seconds, lat, lon, seq)


def marker(taxi, seconds, seq):
    return fix(taxi, seconds, -1.0, -1.0, seq, True)


def frame(spark: SparkSession, fixes, parts: int = 3) -> DataFrame:
    rows = [(t, at(s), lon, lat, q, e) for t, s, lon, lat, q, e in fixes]
    return spark.createDataFrame(rows, FIX_SCHEMA).repartition(parts)


def ordered(fixes):
    by_taxi: dict = {}
    for row in sorted(fixes, key=lambda f: (f[0], f[1], f[5], f[4])):
        by_taxi.setdefault(row[0], []).append(row)
    return by_taxi


def screen(fixes, max_kmh=300.0, trip_end="intent") -> dict:
    """{(taxi, seq, is_trip_end): reason or None}"""
    verdicts = {}
    for taxi, rows in ordered(fixes).items():
        last = None
        for row in rows:
            _, seconds, lon, lat, seq, end = row
            key = (taxi, seq, end)
            verdicts[key] = None
            if end and trip_end == "intent":
                continue
            if last is not None:
                passed = seconds - last[1]
                if passed == 0 and not end:
                    verdicts[key] = "duplicate_time"
                elif passed > 0 and (
                    km((last[3], last[2]), (lat, lon)) / passed * 3600 > max_kmh
                ):
                    verdicts[key] = "impossible_speed"
            if verdicts[key] is None:
                last = row
    return verdicts


def live(fixes) -> dict:
    """Per accepted fix inside the zone: a dict of everything derived."""
    verdicts = screen(fixes)
    out = {}
    for taxi, rows in ordered(fixes).items():
        last, total, spent, speeds = None, 0.0, 0.0, []
        for row in rows:
            _, seconds, lon, lat, seq, end = row
            away = km((lat, lon), CENTRE)
            if verdicts[(taxi, seq, end)] is not None or away > 15:
                continue
            found = {"away": away, "violated": int(away > 10)}
            if last is not None:
                step, passed = km((last[3], last[2]), (lat, lon)), seconds - last[1]
                speed = step / passed * 3600 if passed > 0 else 0.0
                total, spent = total + step, spent + passed
                speeds.append(speed)
                found |= {"step": step, "speed": speed, "speeding": int(speed > 50)}
            found |= {
                "total": total,
                "spent": spent,
                "average": sum(speeds) / len(speeds) if speeds else 0.0,
            }
            out[(taxi, seq)] = found
            last = row
    return out


def fleet(fixes) -> dict:
    """Fleet distance after each segment."""
    found = live(fixes)
    steps = [
        (f[1], f[0], f[4], found[(f[0], f[4])]["step"])
        for f in fixes
        if "step" in found.get((f[0], f[4]), {})
    ]
    out, total = {}, 0.0
    for _, taxi, seq, step in sorted(steps):
        total += step
        out[(taxi, seq)] = total
    return out


def random_fixes(seed: int, taxis: int, most: int, hot: int = 0, markers: bool = False):
    """Random walks with repeated times, far jumps and two vehicles that share
    an id; ``hot`` more rows go to vehicle 0."""
    rng = random.Random(seed)
    fixes, seq = [], 0
    for taxi in range(taxis):
        rows = rng.randint(1, most) + (hot if taxi == 0 else 0)
        seconds, east, north = rng.randint(0, 50), rng.uniform(-12, 12), rng.uniform(-8, 8)
        shared = rng.random() < 0.3 or (hot and taxi == 0)
        for _ in range(rows):
            seconds += rng.choice([0, 0, 1, 5, 30, 60, 300])
            east += rng.uniform(-0.8, 0.8)
            north += rng.uniform(-0.5, 0.5)
            away = 400 if shared and rng.random() < 0.4 else 0
            jump = rng.choice([0] * 9 + [rng.uniform(20, 200)])
            seq += 1
            fixes.append(near(taxi, seconds, east + jump, seq, north + away))
        if markers:
            seq += 1
            fixes.append(marker(taxi, seconds, seq))
    rng.shuffle(fixes)
    return fixes
