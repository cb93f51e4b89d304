"""Cleaning: drop fixes that repeat a time or imply an impossible speed.

Each fix is compared with the last *accepted* fix of its vehicle, so one bad
fix cannot condemn the good ones after it.  That makes it a fold rather than a
``lag``.  Two facts keep it fast and parallel:

* While nothing is rejected the last accepted fix is the previous row.  A
  window computes that comparison for every row inside Spark; Python looks only
  at rows that fail it and at the rows after them, up to the next accepted one.
  Sorted batches stream through ``mapInArrow`` with constant memory.
* Of the rows before a slice of a long history, only the last accepted one
  matters.  Slices are folded at the same time, as if each began a history.
  Two folds that accept the same row agree from there on, so the first rows of
  a slice mostly tell what it ends with from any other start.  Where they do
  not, the slice is folded again, until every slice has been folded from
  exactly what its predecessor ends with.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from itertools import groupby, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfleet.config import LIMITS, Limits
from wayfleet.functions.geo import haversine_km
from wayfleet.functions.points import (
    ACCEPTED,
    IMPOSSIBLE_SPEED,
    REASONS,
    verdict,
)
from wayfleet.operators.track import SLICE, Track
from wayfleet.session import shared_folder

_ENTRY = ("_in_lat", "_in_lon", "_in_us")
_CODE = "_code"
_NTH = "_nth"  # place of a row in its group, for the first rows of each
_HEAD = 8


def screen_fixes(
    fixes: DataFrame,
    track: Track | None = None,
    limits: Limits = LIMITS,
    trip_end: str = "intent",
) -> DataFrame:
    """All fixes with a ``reject_reason``, NULL for accepted ones.

    ``trip_end="intent"`` lets end-of-trip markers pass untouched and keeps
    them out of the comparison; ``"as_wired"`` treats a marker as any other
    position, except that it may repeat a time.
    """
    if trip_end not in ("intent", "as_wired"):
        raise ValueError(f"unknown trip_end mode: {trip_end!r}")
    track = track or Track.of(fixes)
    if trip_end == "as_wired":
        return _screen(fixes, track, limits)
    moving = _screen(fixes.filter(~F.col("is_trip_end")), track, limits)
    markers = fixes.filter("is_trip_end").withColumn(
        "reject_reason", F.lit(None).cast("string")
    )
    return moving.unionByName(markers)


def clean_fixes(fixes: DataFrame, *args, **kwargs) -> DataFrame:
    screened = screen_fixes(fixes, *args, **kwargs)
    return screened.filter(F.col("reject_reason").isNull()).drop("reject_reason")


def rejected_fixes(fixes: DataFrame, *args, **kwargs) -> DataFrame:
    return screen_fixes(fixes, *args, **kwargs).filter(
        F.col("reject_reason").isNotNull()
    )


def _screen(fixes: DataFrame, track: Track, limits: Limits) -> DataFrame:
    marked = track.mark(fixes)
    entries = None
    if track.sliced:
        entries = _settle_slices(marked, track, limits)
    folded = _fold(marked, track, limits, entries)
    reason = F.lit(None).cast("string")
    for code, text in REASONS.items():
        reason = F.when(F.col(_CODE) == code, text).otherwise(reason)
    return folded.select(*fixes.columns, reason.alias("reject_reason"))


def _fold(
    marked: DataFrame, track: Track, limits: Limits, entries: DataFrame | None
) -> DataFrame:
    """Add the verdict code.  ``entries`` gives the accepted fix that precedes
    a slice; without an entry the first row of a group is accepted."""
    rows = marked.withColumn("_us", F.unix_micros("ts"))
    if entries is not None:
        rows = rows.join(F.broadcast(entries), list(track.group), "left")
    else:
        for name, kind in zip(_ENTRY, ("double", "double", "bigint")):
            rows = rows.withColumn(name, F.lit(None).cast(kind))
    here = F.struct(
        F.col("latitude").alias("_p_lat"),
        F.col("longitude").alias("_p_lon"),
        F.col("_us").alias("_p_us"),
    )
    before = F.lag(here).over(track.window())
    rows = rows.withColumn("_before", before)
    rows = rows.withColumn("_opens", F.col("_before").isNull())
    for name, entry in zip(("_p_lat", "_p_lon", "_p_us"), _ENTRY):
        rows = rows.withColumn(name, F.coalesce(F.col(f"_before.{name}"), F.col(entry)))

    passed_us = F.col("_us") - F.col("_p_us")
    km = haversine_km(
        F.col("_p_lat"), F.col("_p_lon"), F.col("latitude"), F.col("longitude")
    )
    speed = km / (passed_us / F.lit(1e6)) * 3600
    too_fast = F.when(passed_us > 0, (speed > limits.max_speed_kmh) & ~F.isnan(speed))
    repeats = (passed_us == 0) & ~F.col("is_trip_end")
    rows = rows.withColumn("_suspect", F.coalesce(too_fast | repeats, F.lit(False)))
    rows = rows.drop("_before", *_ENTRY)
    # The window left the rows in this order already, so no sort is added.
    rows = rows.sortWithinPartitions(*track.group, *track.order)

    keep = marked.columns
    schema = T.StructType(
        [
            *marked.schema.fields,
            T.StructField(_CODE, T.ByteType(), False),
            T.StructField(_NTH, T.ByteType(), False),
        ]
    )
    return rows.mapInArrow(_folder(keep, limits.max_speed_kmh), schema)


def _folder(
    keep: list[str], max_speed_kmh: float
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def column(batch: pa.RecordBatch, name: str) -> np.ndarray:
        return batch.column(name).to_numpy(zero_copy_only=False)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The accepted fix that rows are being compared with while the row
        # before was rejected; None when the row before was accepted.
        last = None
        opened = 0  # where the current group began, counted from this batch
        for batch in batches:
            size = batch.num_rows
            codes = np.zeros(size, dtype=np.int8)
            rows = np.arange(size)
            starts = np.where(column(batch, "_opens"), rows, opened)
            starts = np.maximum.accumulate(starts)
            nth = np.where(rows - starts < _HEAD, rows - starts, _HEAD).astype(np.int8)
            opened = int(starts[-1]) - size if size else opened
            suspects = np.flatnonzero(column(batch, "_suspect"))
            if size and (last is not None or len(suspects)):
                latitude, longitude, micros, marker, opens = (
                    column(batch, c)
                    for c in ("latitude", "longitude", "_us", "is_trip_end", "_opens")
                )
                at = 0
                while True:
                    if last is None:
                        place = np.searchsorted(suspects, at)
                        if place == len(suspects):
                            break
                        at = int(suspects[place])
                        last = tuple(
                            batch.column(c)[at].as_py()
                            for c in ("_p_lat", "_p_lon", "_p_us")
                        )
                        first = at
                    else:
                        first = -1
                    while at < size:
                        if opens[at] and at != first:
                            break  # next group: its own comparison applies
                        code = verdict(
                            last,
                            float(latitude[at]),
                            float(longitude[at]),
                            int(micros[at]),
                            bool(marker[at]),
                            max_speed_kmh,
                        )
                        if code == ACCEPTED:
                            at += 1
                            break
                        codes[at] = code
                        at += 1
                    else:
                        break  # batch ends while rows are still being rejected
                    last = None
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in keep] + [pa.array(codes), pa.array(nth)],
                names=[*keep, _CODE, _NTH],
            )

    return fold


def _settle_slices(marked: DataFrame, track: Track, limits: Limits) -> DataFrame:
    """The accepted fix that precedes each slice of the sliced vehicles.

    A round folds, all at once, the slices for which it is not known yet what
    they end with.  The first of them in each history has its true start, so
    every round settles at least one slice more; the others have a guess.
    Normally the first round settles all.  A history that follows two places by
    turns, as when two vehicles share an id, needs a few rounds.  The few numbers
    that a slice needs stay in tables of the shared folder.
    """
    spark = marked.sparkSession
    base = f"{shared_folder(spark)}/settled-{uuid.uuid4().hex}"
    group = list(track.group)
    unknown = [F.lit(None).cast(k).alias(n) for n, k in zip(_ENTRY, ("double", "double", "bigint"))]
    todo = track.cells().select(*group, *unknown)
    runs, number = None, 0
    while True:
        rows = marked.join(F.broadcast(todo.select(*group)), group, "left_semi")
        found = _summaries(_fold(rows, track, limits, todo), track)
        run = todo.join(found, group, "left").withColumn("_round", F.lit(number))
        run.write.parquet(f"{base}/runs/{number}")
        run = spark.read.schema(run.schema).parquet(f"{base}/runs/{number}")
        runs = run if runs is None else runs.unionByName(run)
        starts = _starts(runs, track, limits)
        starts.write.parquet(f"{base}/starts/{number}")
        starts = spark.read.schema(starts.schema).parquet(f"{base}/starts/{number}")
        todo = starts.filter("_todo").drop("_todo")
        if todo.isEmpty():
            return starts.drop("_todo")
        if number == 0:
            marked = _staged(marked, track)
        number += 1


def _starts(runs: DataFrame, track: Track, limits: Limits) -> DataFrame:
    """What each slice starts from as far as its folds (``runs``) tell, and
    whether it is still to be folded from there.  One row per slice and round
    goes through, in order."""
    keys, size = list(track.keys), _HEAD
    spread = runs.repartition(*keys) if keys else runs.coalesce(1)
    kinds = [runs.schema[c] for c in (*track.group, *_ENTRY)]
    schema = T.StructType([*kinds, T.StructField("_todo", T.BooleanType(), False)])

    def place(found: dict | None) -> tuple | None:
        return None if found is None else tuple(found.values())

    def cells(rows: Iterator[dict]) -> Iterator[tuple]:
        history, state = None, None
        for (key, nth), rounds in groupby(rows, lambda r: (tuple(r[k] for k in keys), r[SLICE])):
            if key != history:
                history, state = key, None
            folds, refused = [], None
            for r in rounds:
                start = tuple(r[c] for c in _ENTRY)
                start = None if start[2] is None else start
                head = sorted(tuple(h.values()) for h in r["head"] or ())
                # A slice that accepts nothing hands on what it was given.
                folds.append((start, head, place(r["end"]) or start))
                refused = place(r["refused"])
            known, end = _end_from(state, folds, limits, size)
            yield (*key, nth, *(state or (None,) * 3), not known)
            if not known:
                # Guess for the slices after it: what the last fold from a
                # true or guessed start ended with, or else the fix that
                # the fold from no start refused last, which one that
                # follows the other place would have accepted.
                other, _, other_end = folds[-1]
                end = (refused or state) if other is None else other_end
            state = end

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields: list[pa.Field] = []

        def rows() -> Iterator[dict]:
            for batch in batches:
                if not fields:
                    fields.extend(batch.schema.field(c) for c in (*keys, SLICE, *_ENTRY))
                    fields.append(pa.field("_todo", pa.bool_()))
                yield from batch.to_pylist()

        found = cells(rows())
        while part := list(islice(found, 10_000)):
            columns = [pa.array(c, f.type) for c, f in zip(zip(*part), fields)]
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in fields])

    ordered = spread.sortWithinPartitions(*track.group, "_round")
    return ordered.mapInArrow(settle, schema)


def _staged(marked: DataFrame, track: Track) -> DataFrame:
    """Rows of the sliced vehicles, written once for the rounds to come."""
    spark = marked.sparkSession
    path = f"{shared_folder(spark)}/sliced-{uuid.uuid4().hex}"
    marked.filter(F.col(SLICE).isNotNull()).write.parquet(path)
    return spark.read.parquet(path)


def _summaries(folded: DataFrame, track: Track) -> DataFrame:
    """Per slice its first rows, with their verdicts, its last accepted fix and
    the last one refused for its speed: bounded aggregates, combined before the
    shuffle."""
    place = F.struct("latitude", "longitude", F.unix_micros("ts").alias("us"))
    order = F.struct(*[F.col(c) for c in track.order])
    head = F.struct(_NTH, "latitude", "longitude", F.unix_micros("ts").alias("us"), "is_trip_end", _CODE)
    accepted = F.col(_CODE) == ACCEPTED
    too_fast = F.col(_CODE) == IMPOSSIBLE_SPEED
    return folded.groupBy(*track.group).agg(
        F.collect_list(F.when(F.col(_NTH) < _HEAD, head)).alias("head"),
        F.max_by(place, F.when(accepted, order)).alias("end"),
        F.max_by(place, F.when(too_fast, order)).alias("refused"),
    )


def _end_from(start, runs: list, limits: Limits, size: int):
    """Whether it is known what a slice ends with from ``start``, and that end.
    ``size`` is how many first rows a fold has kept."""
    for other, _, end in runs:
        if other == start:
            return True, end
    last = start
    first_rows = runs[0][1]
    for place, (_, latitude, longitude, micros, is_marker, _) in enumerate(first_rows):
        code = ACCEPTED
        if last is not None:
            code = verdict(
                last, latitude, longitude, micros, is_marker, limits.max_speed_kmh
            )
        if code == ACCEPTED:
            for _, head, end in runs:
                if head[place][-1] == ACCEPTED:
                    return True, end
            last = (latitude, longitude, micros)
    if len(first_rows) < size:
        return True, last  # that was the whole slice
    return False, None


__all__ = ["clean_fixes", "rejected_fixes", "screen_fixes"]
