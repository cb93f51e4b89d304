"""Work of the router per message: shuffled and parsed once, fields taken once,
stored as columns, tables written by a few tasks a core."""

from __future__ import annotations

import json

import pytest

from tests.test_router import average, line
from wayfleet.catalog import queries
from wayfleet.sources import messages
from wayfleet.sources.messages import NUMBERED_SCHEMA
from wayfleet.streaming.router import MARKS, TopicTables, marks_of, once, routed, rows_of, start_router


def sent(spark, *rows):
    return spark.createDataFrame([(*r, None, None)[:5] for r in rows], NUMBERED_SCHEMA)


def plan(rows):
    return rows._jdf.queryExecution().executedPlan().toString()


def test_fields_are_taken_once_and_stored(spark):
    odd = json.dumps({"taxi_id": "7", "ts": "2008-02-02 13:30:00", "seq": 4.0, "average_speed": "fast", "speed": 1})
    both = json.dumps({"taxi_id": 1, "ts": "2008-02-02 13:30:00", "seq": 1, "total_distance": 2.5, "average_speed": 3.5})
    strange = [("avg_speed", "1", "[1]"), ("avg_speed", "1", "no"), (None, "1", average(1, 1, 1.0)), ("avg_speed", "1", None),
               ("avg_speed", "1", f"[{average(1, 1, 1.0)}]"), ("avg_speed", "1", '{"taxi_id": 1, "taxi_id": 2}')]
    found = routed(sent(spark, ("avg_speed", "7", odd), ("metrics", "1", both), *strange)).persist()
    try:
        for topic in ("avg_speed", "metrics"):
            assert "variant" not in plan(rows_of(found, topic)).split("InMemoryRelation")[0]
        assert [(r.taxi_id, r.seq, r.average_speed) for r in rows_of(found, "avg_speed").collect()] == [(7, 4, None)]
        assert [(r.taxi_id, r.seq, r.total_distance) for r in rows_of(found, "metrics").collect()] == [(1, 1, 2.5)]
        apart = found.filter("NOT is_routed").select("topic", "key", "value").collect()
        assert sorted(map(str, apart)) == sorted(str(r) for r in sent(spark, *strange).select("topic", "key", "value").collect())
        # Of rows the value is not kept beside its columns, nor a column of another topic.
        assert found.filter("is_routed AND value IS NOT NULL").count() == 0
        assert found.filter("average_speed IS NOT NULL").count() == 0
    finally:
        found.unpersist()


def test_messages_are_sorted_after_the_shuffle_only(spark):
    rows = [("metrics", k, "x", b, n) for k in ("1", None) for b in range(3) for n in range(5)]
    free = [("metrics", "1", "y"), ("metrics", "1", "y"), ("metrics", "1", "y", 0)]
    marks = sent(spark, ("metrics", "1", None, 1, 3)).drop("value")
    first = once(sent(spark, *rows, *rows, *free), marks)
    assert "WindowGroupLimit" not in plan(first)
    want = [r for r in rows if r[1] is None or r[3:] > (1, 3)]
    got = [tuple(r) for r in first.collect()]
    assert sorted(r for r in got if r[2] == "x" and r[1]) == sorted(r for r in want if r[1])
    assert sorted(r[3:] for r in got if r[1] is None) == sorted(r[3:] for r in want if r[1] is None)
    assert len([r for r in got if r[2] == "y"]) == 3


def test_marks_are_the_highest_numbers(spark, tmp_path):
    rows = [("metrics", k, "x", b, 100 * (3 - b) + n) for k in ("1", None) for b in range(3) for n in range(4)]
    got = marks_of(sent(spark, *rows))
    assert "SortAggregate" not in plan(got)
    assert got.count() == 6
    TopicTables(str(tmp_path)).write(sent(spark, *rows), 0)
    marks = TopicTables(str(tmp_path)).history(spark, MARKS).collect()
    assert sorted((str(r.key), r.batch, r.nth) for r in marks) == [("1", 2, 103), ("None", 2, 103)]


def test_tables_are_written_by_a_few_tasks_a_core(spark, tmp_path):
    (tmp_path / "topics").mkdir()
    found = [line("avg_speed", str(t), average(t, i, 1.0), 0, 10 * i + t) for t in range(9) for i in range(60)]
    (tmp_path / "topics" / "0.json").write_text("\n".join(found))
    tables = TopicTables(str(tmp_path / "routed"))
    source = messages.file_topics(spark, str(tmp_path / "topics"))
    start_router(source, tables, str(tmp_path / "checkpoint"), available_now=True, partitions=64).awaitTermination()
    rows = tables.history(spark, "avg_speed")
    assert rows.count() == 540
    assert len(rows.inputFiles()) <= 2 * spark.sparkContext.defaultParallelism


def test_a_long_batch_is_waited_for(spark, tmp_path, monkeypatch):
    class Job:
        def stop(self):
            pass

    waits = []
    monkeypatch.setattr(queries, "start_live_job", lambda *_, **__: Job())
    monkeypatch.setattr(queries, "wait_until_silent", lambda job, silence, at_most=300.0: waits.append(at_most))
    (tmp_path / "messages").mkdir()
    queries.run_silent(spark, str(tmp_path))
    assert waits[0] > 3600


class Seen(Exception):
    """What a patched step was given."""


def test_a_resumed_job_reads_stored_trips(spark, tmp_path, monkeypatch):
    """Markers are found once, not anew by everything that reads the halves."""
    events = spark.range(4000).selectExpr("id AS event_id", "id % 5 AS user_id")
    events.write.parquet(str(tmp_path / "events.parquet"))

    def seen(first):
        raise Seen(first)

    monkeypatch.setattr(queries, "LiveAnalysis", seen)
    with pytest.raises(Seen) as found:
        queries._resumed_tables(spark, str(tmp_path))
    first = found.value.args[0]
    plan = first._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan and "Union" not in plan
    assert first.filter("is_trip_end").count() > 0
