"""The outbox, repeats on the way, and the output topics read as a stream."""

from __future__ import annotations

import json
import os

import pytest

from tests.test_layers import rows_of as batch_rows
from wayfleet.config import OUTPUT_TOPICS
from wayfleet.sinks.tables import OUTBOX, LiveTables
from wayfleet.sources import messages
from wayfleet.streaming.processor import OUTPUT_SCHEMA
from wayfleet.streaming.router import TopicTables, start_router


def batch(spark, number, taxis, ended=()):
    return spark.createDataFrame(batch_rows(number, taxis, ended), OUTPUT_SCHEMA)


def one_after_another(folder):
    """Files that were written within one tick of the clock, apart in time: the
    stream reads files in the order of their times."""
    before = 0
    for file in sorted(folder.glob("*.json"), key=lambda f: (f.stat().st_mtime_ns, f.name)):
        before = max(file.stat().st_mtime_ns, before + 1_000_000)
        os.utime(file, ns=(before, before))


def route(spark, base, files=1):
    one_after_another(base / "topics")
    tables = TopicTables(str(base / "routed"))
    job = start_router(
        messages.file_topics(spark, str(base / "topics"), files),
        tables,
        str(base / "checkpoint"),
        available_now=True,
    )
    job.awaitTermination()
    return tables, job


def rows(tables, spark, table):
    return sorted((r.taxi_id, r.seq) for r in tables.history(spark, table).collect())


def test_a_batch_that_runs_twice_is_published_once(spark, tmp_path):
    """Also when its second run gives other rows, as timers may make it."""
    sent = []
    tables = LiveTables(str(tmp_path), publish=lambda m: sent.append(m.collect()))
    tables.write(batch(spark, 0, [1, 2]), 0)
    tables.write(batch(spark, 0, [1, 2, 3]), 0)
    assert sent == []
    tables.write(batch(spark, 1, [1]), 1)
    assert sorted({m.key for m in sent[0]}) == ["1", "2", "3"] and {m.batch for m in sent[0]} == {0}
    assert len({m.nth for m in sent[0]}) == len(sent[0]) == 12
    # The second batch runs again: what the first one sent is sent again, as it was.
    tables.write(batch(spark, 1, [1]), 1)
    assert sorted(sent[0]) == sorted(sent[1])
    assert {m.batch for m in tables.history(spark, OUTBOX).collect()} == {1}
    tables.settle(spark)
    tables.settle(spark)
    assert len(sent) == 3 and {m.batch for m in sent[2]} == {1}
    assert tables.history(spark, OUTBOX).count() == 0
    assert rows(tables, spark, "active_taxi") == [(1, 1), (1, 1001), (2, 2), (3, 3)]


def test_messages_wait_while_nobody_publishes(spark, tmp_path):
    sent = []
    tables = LiveTables(str(tmp_path), publish=lambda m: sent.extend(m.collect()))
    tables.write(batch(spark, 0, [1]), 0)
    tables.publish = None
    tables.write(batch(spark, 1, [1]), 1)
    assert tables.history(spark, OUTBOX).count() == 4
    tables.publish = lambda m: sent.extend(m.collect())
    tables.write(batch(spark, 2, [1]), 2)
    assert {m.batch for m in sent} == {0}


def test_a_send_that_breaks_off(spark, tmp_path):
    def breaks(m):
        messages.publish_files(m.filter("key < '2'"), str(tmp_path / "topics"))
        raise OSError("lost")

    tables = LiveTables(str(tmp_path / "tables"), publish=breaks)
    tables.write(batch(spark, 0, [1, 2]), 0)
    with pytest.raises(OSError, match="lost"):
        tables.write(batch(spark, 1, [1, 2], {1}), 1)
    tables = LiveTables(
        str(tmp_path / "tables"), publish=lambda m: messages.publish_files(m, str(tmp_path / "topics"))
    )
    tables.write(batch(spark, 1, [1, 2], {1}), 1)
    tables.settle(spark)
    got, _ = route(spark, tmp_path)
    for topic in OUTPUT_TOPICS:
        assert rows(got, spark, topic) == rows(tables, spark, topic)
    for topic in ("active_taxi", "over_speeding", "avg_speed", "metrics", "ended_taxi"):
        want = sorted(map(str, tables.served(spark, topic).collect()))
        assert sorted(map(str, got.served(spark, topic).collect())) == want
    assert [r.taxi_id for r in got.latest(spark, "active_taxi").collect()] == [2]
    total = {r.seq: r.total_distance for r in got.history(spark, "metrics").collect()}
    assert total == {r.seq: r.total_distance for r in tables.history(spark, "metrics").collect()}


def line(topic, key, value, batch=None, nth=None):
    found = {"topic": topic, "key": key, "value": value, "batch": batch, "nth": nth}
    return json.dumps({k: v for k, v in found.items() if v is not None})


def average(taxi, seq, speed):
    return json.dumps({"taxi_id": taxi, "ts": f"2008-02-02T13:30:{seq:02}.000Z", "seq": seq, "average_speed": speed})


def test_repeats_over_files_and_batches(spark, tmp_path):
    (tmp_path / "topics").mkdir()
    send = [line("avg_speed", "1", average(1, i, 1.5 * i), i // 3, i % 3) for i in range(9)]
    (tmp_path / "topics" / "0.json").write_text("\n".join([*send[:4], *send[:2]]))
    (tmp_path / "topics" / "1.json").write_text("\n".join(send[2:6]))
    (tmp_path / "topics" / "2.json").write_text("\n".join([*send[3:9], *send[3:9]]))
    # The same numbers under another key or topic are other messages.
    other = [line("avg_speed", "2", average(2, 1, 9.0), 0, 0), line("metrics", "1", average(1, 1, 0), 0, 0)]
    (tmp_path / "topics" / "3.json").write_text("\n".join(other))
    tables, job = route(spark, tmp_path)
    assert rows(tables, spark, "avg_speed") == [*((1, i) for i in range(9)), (2, 1)]
    assert rows(tables, spark, "metrics") == [(1, 1)]
    assert {r.seq: r.average_speed for r in tables.history(spark, "avg_speed").filter("taxi_id = 1").collect()} == {
        i: 1.5 * i for i in range(9)
    }
    assert len(job.lastProgress["sources"]) == 1


def test_strange_messages_are_kept_apart(spark, tmp_path):
    (tmp_path / "topics").mkdir()
    strange = [
        line("elsewhere", "1", average(1, 1, 1.0), 0, 0),
        line("avg_speed", "1", "no json", 0, 1),
        line("avg_speed", "1", "[1, 2]", 0, 2),
        line("avg_speed", "1", json.dumps({"taxi_id": "x", "ts": "2008-02-02 13:30:00", "seq": 1}), 0, 3),
        line("avg_speed", "1", json.dumps({"taxi_id": 1, "ts": "bad", "seq": 1}), 0, 4),
        line("avg_speed", None, None, 0, 5),
        line(None, None, average(1, 1, 1.0)),
    ]
    # Messages without a number pass, as often as they come.
    free = [line("avg_speed", "7", average(7, 1, 1.0))] * 2
    last = line("avg_speed", "7", json.dumps({"taxi_id": 7, "ts": "2008-02-02T13:31:00Z", "seq": 3, "more": [1]}), 0, 0)
    (tmp_path / "topics" / "0.json").write_text("\n".join([*strange, *free, last]))
    tables, _ = route(spark, tmp_path)
    assert tables.history(spark, "unrouted").count() == len(strange)
    found = tables.history(spark, "avg_speed").collect()
    assert sorted((r.taxi_id, r.seq, r.average_speed) for r in found if r.seq < 3) == [(7, 1, 1.0)] * 2
    assert [(r.ts.minute, r.average_speed) for r in found if r.seq == 3] == [(31, None)]


def test_no_messages(spark, tmp_path):
    (tmp_path / "topics").mkdir()
    tables, _ = route(spark, tmp_path)
    assert tables.history(spark, "active_taxi").count() == 0
    assert tables.served(spark, "ended_taxi").first().ended_trip_count == 0


def many_messages(spark, folder, compression="none"):
    sent = spark.range(4000).selectExpr(
        "'active_taxi' AS topic",
        "CAST(id % 40 AS string) AS key",
        "to_json(struct(CAST(id % 40 AS int) AS taxi_id, timestamp_seconds(id) AS ts, id AS seq, 116.4 AS longitude)) AS value",
        "0L AS batch",
        "id AS nth",
    )
    for _ in range(2):
        messages.publish_files(sent.repartition(4), str(folder), compression)
    return sum(f.stat().st_size for f in folder.glob("part-*"))


def test_compressed_topics_are_read_alike(spark, tmp_path):
    plain = many_messages(spark, tmp_path / "plain" / "topics")
    assert many_messages(spark, tmp_path / "small" / "topics", "lz4") < plain / 3
    found = [rows(route(spark, tmp_path / x, 1000)[0], spark, "active_taxi") for x in ("plain", "small")]
    assert found[0] == found[1] == sorted((i % 40, i) for i in range(4000))


def test_batches_of_the_router_are_bounded_by_bytes(spark, tmp_path):
    """And shuffles of earlier batches are let go of before each."""
    size = many_messages(spark, tmp_path / "topics", "lz4")
    dropped = []

    class Watched(TopicTables):
        @staticmethod
        def _drop_shuffles(session):
            dropped.append(1)
            TopicTables._drop_shuffles(session)

    tables = Watched(str(tmp_path / "routed"))
    job = start_router(
        messages.file_topics(spark, str(tmp_path / "topics"), bytes_per_trigger=size // 4),
        tables,
        str(tmp_path / "checkpoint"),
        available_now=True,
    )
    job.awaitTermination()
    batches = [p.batchId for p in job.recentProgress if p.numInputRows]
    assert len(batches) >= 2 and len(dropped) == len(batches)
    assert rows(tables, spark, "active_taxi") == sorted((i % 40, i) for i in range(4000))
