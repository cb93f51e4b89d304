from __future__ import annotations

from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests import model
from wayfleet.functions import geo
from wayfleet.functions import points as points_
from wayfleet.functions.time import event_time_ms, format_timestamp
from wayfleet.sources import logs, messages, tables
from wayfleet.sources.tables import FIX_SCHEMA

GOOD = "1,2008-02-02 15:36:08,116.51172,39.92123"


def write_logs(folder, files):
    folder.mkdir()
    for name, lines in files.items():
        (folder / name).write_text("".join(line + "\n" for line in lines))
    return str(folder)


def test_lines(spark, tmp_path):
    bad = [
        "1,2008-02-02 15:36:08,116.5",
        "1,2008-02-02 15:36:08,116.5,39.9,7",
        "one,2008-02-02 15:36:08,116.5,39.9",
        "1,bad,116.5,39.9",
        "1,2008-02-30 15:36:08,116.5,39.9",
        "1,2008-02-02 15:36:08,east,39.9",
        "",
    ]
    folder = write_logs(
        tmp_path / "logs",
        {
            "1.txt": [GOOD, *bad, "1,2008-2-2 1:2:3, 116.5 ,39.9"],
            "2.txt": ["nothing", "useful"],
            "3.txt": [],
            "4.csv": [GOOD],
        },
    )
    lines = logs.read_log_lines(spark, folder)
    fixes = logs.valid_fixes(lines).orderBy("seq").collect()
    assert [(r.taxi_id, r.ts, r.longitude, r.latitude) for r in fixes] == [
        (1, datetime(2008, 2, 2, 15, 36, 8), 116.51172, 39.92123),
        (1, datetime(2008, 2, 2, 1, 2, 3), 116.5, 39.9),
    ]
    rejected = [r.value for r in logs.rejected_lines(lines).collect()]
    assert sorted(rejected) == sorted([*bad, "nothing", "useful"])

    # The marker repeats the last valid line of its file, whatever its time.
    (end,) = logs.log_fixes(spark, folder).filter("is_trip_end").collect()
    assert (end.taxi_id, end.ts) == (1, datetime(2008, 2, 2, 1, 2, 3))
    assert (end.longitude, end.latitude) == (-1.0, -1.0)
    assert end.source_file.endswith("/1.txt")


def test_line_order_over_many_blocks(spark, tmp_path):
    """Sequence numbers grow along a file, though it is read in many blocks
    next to other files."""
    files = {
        f"{taxi}.txt": [f"{taxi},2008-02-02 15:36:08,{116 + i / 1e5},39.9" for i in range(n)]
        for taxi, n in {1: 900, 2: 5, 3: 60, 4: 300}.items()
    }
    folder = write_logs(tmp_path / "logs", files)
    settings = {
        "spark.sql.files.maxPartitionBytes": "4096",
        "spark.sql.files.openCostInBytes": "16",
    }
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        lines = logs.read_log_lines(spark, folder)
        assert lines.rdd.getNumPartitions() > 8
        rows = logs.valid_fixes(lines).orderBy("taxi_id", "seq").collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    for taxi, lines in files.items():
        taxi = int(taxi.split(".")[0])
        mine = [r for r in rows if r.taxi_id == taxi]
        assert [r.longitude for r in mine] == [116 + i / 1e5 for i in range(len(lines))]
        assert len({r.seq for r in mine}) == len(lines)


def test_processed_table(spark, tmp_path):
    fixes = model.random_fixes(41, 10, 20, markers=True)
    rows = model.frame(spark, fixes)
    path = str(tmp_path / "fixes")
    built = []

    def build():
        built.append(1)
        return rows

    stored = tables.read_or_build(spark, path, build)
    again = tables.read_or_build(spark, path, build)
    assert len(built) == 1
    for table in (stored, again):
        same = table.select(rows.columns)
        assert same.exceptAll(rows).count() == 0 and rows.exceptAll(same).count() == 0
    assert stored.select(*FIX_SCHEMA.fieldNames()).schema == FIX_SCHEMA

    late = stored.filter(F.col("ts") >= "2008-02-02 14:00:00").select("ts")
    plan = late._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan and "longitude" not in plan


def test_csv(spark, tmp_path):
    rows = spark.range(10).select("id", (F.col("id") / 4).alias("km"))
    tables.write_csv(rows, str(tmp_path / "out"))
    back = spark.read.option("header", True).schema("id bigint, km double")
    assert back.csv(str(tmp_path / "out")).exceptAll(rows).count() == 0


def test_messages(spark):
    fixes = model.random_fixes(42, 5, 10, markers=True)
    rows = model.frame(spark, fixes)
    sent = messages.encode(rows)
    assert sent.columns == ["key", "value", "seq"]
    back = messages.decode(sent).select(rows.columns)
    assert back.exceptAll(rows).count() == 0 and rows.exceptAll(back).count() == 0

    one = messages.encode(model.frame(spark, [model.fix(7, 8, 39.5, 116.25, 1)])).first()
    assert one.key == "7"
    assert one.value == (
        '{"taxi_id":7,"timestamp":"2008-02-02 13:30:08","longitude":116.25,"latitude":39.5}'
    )


def test_bad_messages_are_set_apart(spark):
    values = [
        '{"taxi_id":1,"timestamp":"2008-02-02 13:30:08","longitude":1.5,"latitude":2.5}',
        '{"taxi_id":1,"timestamp":"soon","longitude":1.5,"latitude":2.5}',
        '{"taxi_id":1}',
        "no json",
    ]
    sent = spark.createDataFrame([(str(i), v, i) for i, v in enumerate(values)], "key string, value string, seq bigint")
    assert [r.seq for r in messages.complete_fixes(sent).collect()] == [0]
    rejected = messages.rejected_messages(sent)
    assert {(r.value, r.seq) for r in rejected.collect()} == {
        (v, i) for i, v in enumerate(values) if i
    }


def test_topics(spark):
    rows = spark.createDataFrame([(1, 2.5), (2, 3.5)], "taxi_id int, average_speed double")
    total = spark.createDataFrame([(9.5,)], "total_distance double")
    sent = messages.tag_topics({"avg_speed": rows, "metrics": total})
    assert {(r.topic, r.key) for r in sent.collect()} == {
        ("avg_speed", "1"), ("avg_speed", "2"), ("metrics", "metrics"),
    }
    back = messages.route(sent, "avg_speed", rows.schema)
    assert back.exceptAll(rows).count() == 0 and back.count() == 2
    assert messages.route(sent, "metrics", total.schema).first().total_distance == 9.5


def test_time_values(spark):
    row = model.frame(spark, [model.near(1, 5, 0, 1)]).select(
        event_time_ms(F.col("ts")).alias("ms"), format_timestamp(F.col("ts")).alias("text")
    ).first()
    assert (row.ms, row.text) == (1201959005000, "2008-02-02 13:30:05")


def test_a_path_that_is_no_complete_table_is_left_alone(spark, tmp_path):
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "note.txt").write_text("mine")
    with pytest.raises(FileExistsError):
        tables.read_or_build(spark, str(tmp_path / "t"), lambda: None)
    assert (tmp_path / "t" / "note.txt").read_text() == "mine"


def test_places_that_are_no_numbers_are_rejected(spark):
    values = ["NaN", "Infinity", "-Infinity", "116.4"]
    lines = spark.createDataFrame([(f"1,2008-02-02 13:30:00,{v},39.9",) for v in values], "value string")
    assert [r.is_valid for r in logs.parse_lines(lines).collect()] == [False, False, False, True]
    sent = spark.createDataFrame(
        [("1", f'{{"taxi_id":1,"timestamp":"2008-02-02 13:30:00","longitude":{v if i == 3 else f'"{v}"'},"latitude":39.9}}', i) for i, v in enumerate(values)],
        "key string, value string, seq bigint",
    )
    assert [r.seq for r in messages.complete_fixes(sent).collect()] == [3]
    assert {r.seq for r in messages.rejected_messages(sent).collect()} == {0, 1, 2}


def test_distances_agree_on_nan(spark):
    points = [(39.9, 116.4, 39.8, 116.5), (float("nan"), 116.4, 39.8, 116.5), (0.0, 0.0, 0.0, 180.0), (90.0, 0.0, -90.0, 0.0)]
    rows = spark.createDataFrame(points, "a double, b double, c double, d double")
    got = [r[0] for r in rows.select(geo.haversine_km(*map(F.col, "abcd"))).collect()]
    one = [points_.distance_km(*p) for p in points]
    many = points_.distances_km(*np.array(points).T)
    assert np.allclose(got, one, equal_nan=True) and np.allclose(got, many, equal_nan=True)
    assert np.isnan(got[1])
