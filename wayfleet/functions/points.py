"""Point arithmetic for code that runs inside Python tasks (the cleaning fold
and the streaming processor).  Same formula as ``functions.geo``."""

from __future__ import annotations

from math import asin, cos, radians, sin, sqrt

import numpy as np

from wayfleet.config import EARTH_RADIUS_KM


def distance_km(lat_a: float, lon_a: float, lat_b: float, lon_b: float) -> float:
    half_lat = sin(radians(lat_b - lat_a) / 2)
    half_lon = sin(radians(lon_b - lon_a) / 2)
    chord = half_lat * half_lat + (
        cos(radians(lat_a)) * cos(radians(lat_b)) * half_lon * half_lon
    )
    return 2 * EARTH_RADIUS_KM * asin(1.0 if chord > 1 else sqrt(chord))


def distances_km(lat_a, lon_a, lat_b, lon_b) -> np.ndarray:
    half_lat = np.sin(np.radians(np.subtract(lat_b, lat_a)) / 2)
    half_lon = np.sin(np.radians(np.subtract(lon_b, lon_a)) / 2)
    chord = half_lat * half_lat + (
        np.cos(np.radians(lat_a)) * np.cos(np.radians(lat_b)) * half_lon * half_lon
    )
    return 2 * EARTH_RADIUS_KM * np.arcsin(np.minimum(1.0, np.sqrt(chord)))


ACCEPTED, DUPLICATE_TIME, IMPOSSIBLE_SPEED = 0, 1, 2
REASONS = {DUPLICATE_TIME: "duplicate_time", IMPOSSIBLE_SPEED: "impossible_speed"}


def verdict(last, latitude, longitude, micros, is_marker, max_speed_kmh) -> int:
    """Check one fix against ``last = (latitude, longitude, micros)``, the last
    accepted fix of the same vehicle."""
    if micros == last[2] and not is_marker:
        return DUPLICATE_TIME
    if micros > last[2]:
        km = distance_km(last[0], last[1], latitude, longitude)
        if km / ((micros - last[2]) / 1e6) * 3600 > max_speed_kmh:
            return IMPOSSIBLE_SPEED
    return ACCEPTED


def fold(latitude, longitude, micros, is_marker, last, max_speed_kmh):
    """Verdicts of ordered fixes of one vehicle, and the last accepted fix.

    While nothing is rejected, a fix is compared with the row before it, which
    works on whole columns.  Only where that fails does the comparison go row by
    row, up to the next accepted fix.
    """
    size = len(micros)
    codes = np.zeros(size, dtype=np.int8)
    if not size:
        return codes, last

    def point(i: int):
        return float(latitude[i]), float(longitude[i]), int(micros[i])

    passed = np.diff(micros)
    km = distances_km(latitude[:-1], longitude[:-1], latitude[1:], longitude[1:])
    with np.errstate(divide="ignore", invalid="ignore"):
        too_fast = (passed > 0) & (km / (passed / 1e6) * 3600 > max_speed_kmh)
    suspects = np.flatnonzero(too_fast | ((passed == 0) & ~is_marker[1:])) + 1
    at = 0
    if last is None:
        last, at = point(0), 1
    while True:
        # Compare with ``last`` up to an accepted row.
        while at < size:
            code = verdict(last, *point(at), bool(is_marker[at]), max_speed_kmh)
            if code == ACCEPTED:
                break
            codes[at] = code
            at += 1
        if at == size:
            return codes, last
        # From there on rows pass until the next suspect.
        place = np.searchsorted(suspects, at + 1)
        if place == len(suspects):
            return codes, point(size - 1)
        at = int(suspects[place])
        last = point(at - 1)


def fold_many(latitude, longitude, micros, is_marker, whose, last, has_last, max_speed_kmh):
    """Verdicts of ordered fixes of many vehicles.  ``whose`` has the vehicle of
    each fix, ascending, as an index of ``has_last`` and of the columns of
    ``last``, the last accepted fixes.

    As in ``fold``, only rows that fail against the row before, and those after
    them up to the next accepted one, are looked at one by one, and with them
    the first row of each vehicle that is compared with any.
    """
    size = len(micros)
    codes = np.zeros(size, dtype=np.int8)
    if not size:
        return codes

    def point(i: int):
        return float(latitude[i]), float(longitude[i]), int(micros[i])

    first = np.diff(whose, prepend=-1) != 0
    passed = np.diff(micros)
    km = distances_km(latitude[:-1], longitude[:-1], latitude[1:], longitude[1:])
    with np.errstate(divide="ignore", invalid="ignore"):
        too_fast = (passed > 0) & (km / (passed / 1e6) * 3600 > max_speed_kmh)
    begins = first & ~has_last[whose]
    suspects = np.r_[False, too_fast | ((passed == 0) & ~is_marker[1:]) | begins[:-1]]
    done = 0
    for at in np.flatnonzero(np.where(first, ~begins, suspects)).tolist():
        if at < done:
            continue
        vehicle = whose[at]
        end = int(np.searchsorted(whose, vehicle, "right"))
        if first[at]:
            lat, lon, us = (column[vehicle] for column in last)
            against = float(lat), float(lon), int(us)
        else:
            against = point(at - 1)
        while at < end:
            code = verdict(against, *point(at), bool(is_marker[at]), max_speed_kmh)
            if code == ACCEPTED:
                break
            codes[at] = code
            at += 1
        done = min(at + 1, end)
    return codes
