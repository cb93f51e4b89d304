"""Tables in layers: how they merge, what a commit shows, what stays on disk."""

from __future__ import annotations

import random
from pathlib import Path

import pytest

from tests import model
from wayfleet.sinks.layers import merged_from
from wayfleet.sinks.tables import LiveTables
from wayfleet.streaming.processor import OUTPUT_SCHEMA


def grown(sizes, fan, closed=None, distinct=None):
    """Layers after batches of these sizes, and the rows written for each."""
    layers, written = [], []
    for size in sizes:
        first = merged_from([*layers, size], fan, closed)
        total = sum(layers[first:]) + size
        layers[first:] = [min(total, distinct) if distinct else total]
        written.append(layers[-1])
    return layers, written


@pytest.mark.parametrize("fan", [2, 3, 8])
def test_layers_and_writes_follow_the_logarithm(fan):
    rng = random.Random(fan)
    for sizes in ([1] * 1000, [500] * 1000, [rng.choice((1, 7, 90, 4000)) for _ in range(1000)]):
        layers, written = grown(sizes, fan)
        levels = 1
        while fan**levels <= sum(sizes):
            levels += 1
        assert sum(layers) == sum(sizes) and len(layers) <= fan * levels
        assert sum(written) <= (levels + 1) * sum(sizes)


def test_a_small_batch_leaves_a_large_fleet_alone():
    layers, written = grown([10**7] + [10] * 1000, 8, distinct=10**7)
    assert layers[0] == 10**7 and max(written[1:]) < 10**5
    assert sum(written[1:]) <= 6 * 10 * 1000


def test_closed_layers_are_final():
    layers, written = grown([10] * 1000, 4, closed=160)
    assert max(written) < 4 * 160 and sum(layers) == 10_000
    assert merged_from([200, 200, 200, 200], 4, 160) == 3
    assert merged_from([1], 2) == 0


def rows_of(batch, taxis, ended=()):
    """A fix of each taxi in one batch, and markers of some."""
    rows = []
    for taxi in taxis:
        at, seq = model.at(60 * batch), 1000 * batch + taxi
        rows.append((taxi, at, 116.4, 39.9, seq, False, None, 1.0, 0, 2.0, 30.0 + batch, 0, 2.0, 60.0, 30.0, None, False))
        if taxi in ended:
            rows.append((taxi, at, -1.0, -1.0, seq, True, None, *[None] * 8, batch, False))
    return rows


def state(tables, spark):
    """Rows of every table, to be compared."""
    histories = {
        name: sorted((r.taxi_id, r.seq) for r in tables.history(spark, name).collect())
        for name in ("active_taxi", "over_speeding", "avg_speed", "metrics", "ended_taxi")
    }
    served = {
        name: sorted((r.taxi_id, r.seq) for r in tables.latest(spark, name).collect())
        for name in ("active_taxi", "over_speeding", "avg_speed", "ended_taxi")
    }
    return histories, served, tables.served(spark, "metrics").first().total_distance


def test_many_batches(spark, tmp_path):
    rng = random.Random(5)
    tables = LiveTables(str(tmp_path), fan=2, kept_versions=2, closed_rows=30)
    last, ended, n, closed = {}, set(), 0, 0
    for batch in range(12):
        taxis = range(40) if batch == 0 else rng.sample(range(40), 3)
        off = set(taxis[:1]) if batch % 3 == 2 else set()
        tables.write(spark.createDataFrame(rows_of(batch, taxis, off), OUTPUT_SCHEMA), batch)
        n += len(taxis)
        for taxi in taxis:
            last[taxi] = 1000 * batch + taxi
            ended = (ended - {taxi}) | (off & {taxi})
    histories, served, total = state(tables, spark)
    assert len(histories["active_taxi"]) == len(histories["metrics"]) == n and total == 2 * n
    assert served["avg_speed"] == sorted(last.items())
    assert served["active_taxi"] == sorted((t, s) for t, s in last.items() if t not in ended)
    now = tables.log.newest(spark)
    assert now.batch == 11 and len(tables.log.numbers(spark)) == 2
    # The first batch has more rows than a final layer, so it was never written again.
    assert now.layers("active_taxi")[0].path.startswith("active_taxi/0-") and now.layers("active_taxi")[0].rows == 40
    for name, layers in now.tables.items():
        kept = [p for p in (Path(tmp_path) / name).iterdir() if p.is_dir()]
        assert len(layers) <= 8 and len(kept) <= len(layers) + 6


def test_a_crash_between_tables_shows_nothing(spark, tmp_path, monkeypatch):
    tables = LiveTables(str(tmp_path), fan=2)
    for batch in range(3):
        tables.write(spark.createDataFrame(rows_of(batch, range(4)), OUTPUT_SCHEMA), batch)
    before = state(tables, spark)
    later = spark.createDataFrame(rows_of(3, range(2, 6), {2}), OUTPUT_SCHEMA)
    layered = LiveTables._layered

    def broken(self, table, *rest):
        found = layered(self, table, *rest)
        if table == "served/avg_speed":
            raise OSError("lost")
        return found

    monkeypatch.setattr(LiveTables, "_layered", broken)
    with pytest.raises(OSError, match="lost"):
        tables.write(later, 3)
    assert state(tables, spark) == before
    monkeypatch.undo()
    # The job that goes on removes what was left, and has the batch once.
    again = LiveTables(str(tmp_path), fan=2)
    again.write(later, 3)
    histories, served, total = state(again, spark)
    assert len(histories["avg_speed"]) == 16 and total == 32.0
    assert [t for t, _ in served["active_taxi"]] == [0, 1, 3, 4, 5]
    assert not any(n.startswith("3-") and f"avg_speed/{n}" not in again.log.newest(spark).paths() for n in again.log.names(spark, "avg_speed"))


def test_a_batch_that_runs_again_replaces_itself(spark, tmp_path):
    tables = LiveTables(str(tmp_path), kept_versions=1)
    tables.write(spark.createDataFrame(rows_of(0, range(3)), OUTPUT_SCHEMA), 0)
    for taxis in ((0, 1), (2,), (1, 2)):  # timers may fire in other batches
        tables.write(spark.createDataFrame(rows_of(1, taxis), OUTPUT_SCHEMA), 1)
    histories, served, total = state(tables, spark)
    assert histories["active_taxi"] == [(0, 0), (1, 1), (1, 1001), (2, 2), (2, 1002)] and total == 10.0
    assert served["avg_speed"] == [(0, 0), (1, 1001), (2, 1002)]
    tables.write(spark.createDataFrame(rows_of(2, [0]), OUTPUT_SCHEMA), 2)
    tables.write(spark.createDataFrame(rows_of(3, [0]), OUTPUT_SCHEMA), 3)
    with pytest.raises(RuntimeError, match="no longer kept"):
        tables.write(spark.createDataFrame(rows_of(0, [0]), OUTPUT_SCHEMA), 0)
