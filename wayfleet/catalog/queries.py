"""Registered queries: every operator over the whole ``events`` table."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfleet.config import (
    ACTIVE,
    AVERAGES,
    ENDED,
    LIMITS,
    METRICS,
    SPEEDS,
    ZONE,
    Sizing,
)
from wayfleet.functions.geo import distance_to_zone_km
from wayfleet.functions.time import event_time_ms, format_timestamp
from wayfleet.operators import (
    clean,
    explore,
    geofence,
    motion,
    replay,
    serve,
    trips,
)
from wayfleet.operators.track import Track
from wayfleet.plans.live import FLEET_ORDER, LiveAnalysis
from wayfleet.plans.offline import CENTRE_DISTANCE, TAXI_ORDER, OfflineAnalysis
from wayfleet.session import shared_folder
from wayfleet.sinks.tables import REJECTS, LiveTables
from wayfleet.sources import messages
from wayfleet.sources.events import as_log_lines, read_event_fixes, with_copies
from wayfleet.sources.incremental import LogTable
from wayfleet.sources.logs import read_log_lines, rejected_lines, valid_fixes, write_logs
from wayfleet.sources.tables import read_fixes, write_csv, write_fixes
from wayfleet.streaming.job import start_live_job, start_quarantine, wait_until_silent
from wayfleet.streaming.router import TopicTables, start_router
from wayfleet.streaming.start import starting_state

Query = Callable[[SparkSession, str], DataFrame]

_FIX = ["taxi_id", "ts", "longitude", "latitude", "seq"]
_AT = ["taxi_id", "ts", "seq"]
_DISTANCE = geofence.DISTANCE

# Each table is measured and derived once per session and state of its files.
_tracks: dict[tuple, Track] = {}
_tables: dict[tuple, str] = {}
_streams: dict[tuple, LiveTables | TopicTables] = {}


def _state(spark: SparkSession, folder: str) -> tuple:
    """The session, and the names, sizes and times of the event files."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{folder}/events.parquet")
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = ((s.getPath().toString(), s.getLen(), s.getModificationTime()) for s in files.listStatus(path))
    return (spark.sparkContext.applicationId, folder, *sorted(found))


def _track(spark: SparkSession, folder: str, keys=("taxi_id",), order=None) -> Track:
    known = (*_state(spark, folder), keys, order)
    if known not in _tracks:
        fixes = _fixes(spark, folder)
        _tracks[known] = Track.of(fixes, keys, order) if order else Track.of(fixes, keys)
    return _tracks[known]


def _fixes(spark: SparkSession, folder: str) -> DataFrame:
    """The processed table of ``folder``: fixes are derived from all its events
    once per session and stored by day and time, as parsed logs would be."""
    known = _state(spark, folder)
    if known not in _tables:
        path = _new_folder(spark, "fixes")
        write_fixes(read_event_fixes(spark, folder), path)
        _tables[known] = path
    return read_fixes(spark, _tables[known]).drop("day")


def _trips(spark: SparkSession, folder: str) -> DataFrame:
    """Fixes with markers, as if each vehicle wrote one log file per hour."""
    name = F.concat(
        F.col("taxi_id").cast("string"), F.lit("_"), F.date_format("ts", "yyyyMMddHH"), F.lit(".txt")
    )
    logged = _fixes(spark, folder).withColumn("source_file", name)
    return trips.with_trip_ends(logged, ["source_file"])


def _live(spark: SparkSession, folder: str) -> LiveAnalysis:
    return LiveAnalysis(
        _fixes(spark, folder),
        track=_track(spark, folder),
        fleet=_track(spark, folder, (), FLEET_ORDER),
    )


# Slices as small as this put every vehicle of the test tables on the path of
# long histories.
_SMALL_SLICES = Sizing(slice_rows=25)


def _sliced(spark: SparkSession, folder: str) -> LiveAnalysis:
    return LiveAnalysis(_fixes(spark, folder), sizing=_SMALL_SLICES)


def _live_trips(spark, folder, trip_end="intent") -> LiveAnalysis:
    return LiveAnalysis(
        _trips(spark, folder).drop("source_file"),
        trip_end=trip_end,
        track=_track(spark, folder),
        fleet=_track(spark, folder, (), FLEET_ORDER),
    )


def _offline(spark: SparkSession, folder: str) -> OfflineAnalysis:
    return OfflineAnalysis(
        with_copies(_fixes(spark, folder)),
        track=_track(spark, folder),
        by_taxi=_track(spark, folder, (), TAXI_ORDER),
    )


def _new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _rounded(rows: DataFrame, places: int, *columns: str) -> DataFrame:
    return rows.withColumns({c: F.round(c, places) for c in columns})


# -- sources and sinks --------------------------------------------------------


def processed_table(spark, folder):
    path = _new_folder(spark, "fixes")
    write_fixes(_trips(spark, folder), path)
    return read_fixes(spark, path).drop("day")


def csv_export(spark, folder):
    path = _new_folder(spark, "distance")
    write_csv(distance_over_time(spark, folder), path)
    schema = "taxi_id int, ts timestamp, seq bigint, total_distance double"
    return spark.read.option("header", True).schema(schema).csv(path)


def _lines(spark, folder):
    """Log files of the fixes, some lines damaged, written and read as text."""
    path = _new_folder(spark, "logs")
    as_log_lines(_fixes(spark, folder)).select("value").write.text(path)
    return read_log_lines(spark, path)


def parse_valid(spark, folder):
    return valid_fixes(_lines(spark, folder)).select(*_FIX[:4], "is_trip_end")


def incremental_table(spark, folder):
    """Logs of one file per vehicle and half of the time, read in two steps."""
    base = _new_folder(spark, "growing")
    table = LogTable(f"{base}/table", f"{base}/logs")
    fixes = _fixes(spark, folder)
    cut = fixes.agg(F.floor(F.max("seq") / 16) * 8).first()[0] or 0
    line = F.concat_ws(",", F.col("taxi_id").cast("string"), format_timestamp(F.col("ts")), "longitude", "latitude")
    for part, half in (("first", F.col("seq") < cut), ("second", F.col("seq") >= cut)):
        sent = fixes.filter(half).select(F.col("taxi_id").alias("vehicle"), "seq", line.alias("value"))
        write_logs(sent, f"{base}/logs", part, 4 * spark.sparkContext.defaultParallelism)
        table.refresh(spark)
    return table.read(spark).select(*_FIX[:4], "is_trip_end")


def parse_rejects(spark, folder):
    return rejected_lines(_lines(spark, folder)).select("value")


def json_decode(spark, folder):
    return messages.decode(messages.encode(_fixes(spark, folder)))


def topic_union(spark, folder):
    """Five tagged topics in one stream of messages, summed up per topic."""
    live = _live_trips(spark, folder).staged(_new_folder(spark, "live"))
    sent = messages.tag_topics(live.outputs())
    return (
        sent.select("topic", F.from_json("value", "taxi_id int, seq bigint").alias("r"))
        .groupBy("topic")
        .agg(
            F.count(F.lit(1)).alias("messages"),
            F.count_distinct("r.taxi_id").alias("taxis"),
            F.sum("r.seq").alias("seq_sum"),
        )
    )


def _topic(topic, rounded=None, places=6):
    """Rows of one topic: encoded, tagged, told apart again and decoded."""

    def query(spark, folder):
        outputs = _live_trips(spark, folder).staged(_new_folder(spark, "live")).outputs()
        rows = messages.route(messages.tag_topics(outputs), topic, outputs[topic].schema)
        return _rounded(rows, places, rounded) if rounded else rows

    return query


# -- projections and filters --------------------------------------------------


def geo_distance(spark, folder):
    km = F.round(distance_to_zone_km(ZONE), 6).alias("distance_km")
    return _fixes(spark, folder).select("taxi_id", "seq", km)


def geofence_active(spark, folder):
    active = geofence.inside_zone(_fixes(spark, folder))
    return _rounded(active.select(*_FIX, _DISTANCE, "is_violated"), 6, _DISTANCE)


def geofence_band_counts(spark, folder):
    counts = geofence.band_counts(geofence.inside_zone(_fixes(spark, folder)))
    return _rounded(counts, 6, "max_distance")


# -- cleaning -----------------------------------------------------------------


def clean_rejects(spark, folder):
    rejected = clean.rejected_fixes(_fixes(spark, folder), _track(spark, folder))
    return rejected.select(*_FIX, "reject_reason")


def clean_as_wired(spark, folder):
    rows = _live_trips(spark, folder, "as_wired").screened()
    return rows.select(*_FIX, "is_trip_end", "reject_reason")


# -- live analysis ------------------------------------------------------------


def active_taxi(spark, folder):
    rows = _live(spark, folder).active().select(*_FIX, _DISTANCE, "is_violated")
    return _rounded(rows, 6, _DISTANCE)


def segment_distance(spark, folder):
    rows = motion.segments_only(_live(spark, folder).segments())
    return _rounded(rows.select(*_FIX, "segment_km"), 6, "segment_km")


def segment_speed(spark, folder):
    rows = _live(spark, folder).speeds().select(*_FIX, "speed", "is_speeding")
    return _rounded(rows, 6, "speed")


def segment_speed_sliced(spark, folder):
    rows = _sliced(spark, folder).speeds().select(*_FIX, "speed", "is_speeding")
    return _rounded(rows, 6, "speed")


def avg_speed_running_sliced(spark, folder):
    rows = _sliced(spark, folder).averages().select(*_AT, "average_speed")
    return _rounded(rows, 6, "average_speed")


def fleet_running_distance_sliced(spark, folder):
    rows = _sliced(spark, folder).metrics().select(*_AT, "total_distance")
    return _rounded(rows, 4, "total_distance")


def speeding_counts(spark, folder):
    return (
        _live(spark, folder)
        .speeds()
        .groupBy("is_speeding")
        .agg(
            F.count(F.lit(1)).alias("segments"),
            F.count_distinct("taxi_id").alias("taxis"),
        )
    )


def speed_history(spark, folder):
    """Pages of 20 speeds, shown in metres per hour as text."""
    live = _live(spark, folder)
    pages = motion.speed_history(live.segments(), live.track, page=20)
    whole = F.transform("speeds", lambda s: F.round(s * 1000).cast("bigint").cast("string"))
    return pages.select(
        "taxi_id",
        "page",
        F.size("speeds").cast("bigint").alias("n_speeds"),
        F.array_join(whole, ",").alias("speeds_m_per_h"),
    )


def _averages(column, places):
    def query(spark, folder):
        rows = _live(spark, folder).averages()
        return _rounded(rows.select(*_AT, column), places, column)

    return query


def taxi_total_distance(spark, folder):
    totals = motion.taxi_totals(_live(spark, folder).segments())
    rows = totals.select("taxi_id", "taxi_distance", "segments")
    return _rounded(rows, 4, "taxi_distance")


def avg_speed_final(spark, folder):
    totals = motion.taxi_totals(_live(spark, folder).segments())
    return _rounded(totals.select("taxi_id", "average_speed"), 6, "average_speed")


def fleet_running_distance(spark, folder):
    rows = _live(spark, folder).metrics().select(*_AT, "total_distance")
    return _rounded(rows, 4, "total_distance")


def fleet_total_distance(spark, folder):
    return _rounded(
        motion.fleet_total(_live(spark, folder).segments()), 4, "total_distance"
    )


def ended_running(spark, folder):
    return _live_trips(spark, folder).ended().select(*_AT, "ended_trip_count")


def ended_as_wired(spark, folder):
    return trips.ended_fleet(_live_trips(spark, folder, "as_wired").active())


# -- served tables ------------------------------------------------------------


def latest_active(spark, folder):
    rows = serve.latest_by_key(_live(spark, folder).active())
    return _rounded(rows.select(*_FIX, _DISTANCE, "is_violated"), 6, _DISTANCE)


def latest_active_open(spark, folder):
    """Active documents when the trip of every vehicle that has been silent for
    a minute has ended."""
    live = _live(spark, folder)
    newest = live.fixes.agg(F.max("ts")).scalar()
    ended = trips.trip_end_rows(
        live.fixes.withColumn("source_file", F.col("taxi_id").cast("string")),
        ["source_file"],
    ).filter(F.col("ts") < newest - F.expr("INTERVAL 60 SECONDS"))
    moves = live.active().select(*_FIX, "is_trip_end")
    latest = serve.latest_by_key(moves.unionByName(ended.drop("source_file")))
    return serve.without_ended(latest).select(*_FIX)


def latest_speed(spark, folder):
    latest = serve.taxi_document(serve.latest_by_key(_live(spark, folder).speeds()))
    rows = latest.select(*_FIX, "speed", "is_speeding", "taxi_description")
    return _rounded(rows, 6, "speed")


def latest_avg_speed(spark, folder):
    latest = serve.taxi_document(serve.latest_by_key(_live(spark, folder).averages()))
    rows = latest.select(*_AT, "average_speed", "taxi_description")
    return _rounded(rows, 6, "average_speed")


def latest_fleet_total(spark, folder):
    rows = _live(spark, folder).metrics().select(*_AT, "total_distance")
    return _rounded(serve.latest_by_key(rows, [], FLEET_ORDER), 4, "total_distance")


def latest_ended(spark, folder):
    rows = _live_trips(spark, folder).ended()
    return serve.latest_by_key(rows, []).select("ended_trip_count")


def serve_active_doc(spark, folder):
    latest = serve.latest_by_key(_live(spark, folder).active())
    document = serve.active_document(latest).select(
        *_AT,
        F.col("location.lon").alias("location_lon"),
        F.col("location.lat").alias("location_lat"),
        _DISTANCE,
        "is_violated",
        "taxi_description",
        "is_violated_text",
    )
    return _rounded(document, 6, _DISTANCE)


def serve_metrics_doc(spark, folder):
    return serve.metrics_document(motion.fleet_total(_live(spark, folder).segments()))


# -- offline analysis ---------------------------------------------------------


def split_counts(spark, folder):
    return (
        _trips(spark, folder)
        .groupBy("is_trip_end")
        .agg(F.count(F.lit(1)).alias("fixes"), F.count_distinct("taxi_id").alias("taxis"))
    )


def dup_times_one_taxi(spark, folder):
    rows = explore.of_taxi(_offline(spark, folder).repeated_times(), 7)
    return explore.value_counts(rows, "ts")


def radius_filter(spark, folder):
    rows = _offline(spark, folder).within_radius().select(*_FIX, CENTRE_DISTANCE)
    return _rounded(rows, 6, CENTRE_DISTANCE)


def lag_columns(spark, folder):
    previous = [f"previous_{c}" for c in ("latitude", "longitude", "timestamp")]
    return _offline(spark, folder).steps().select(*_FIX, *previous)


def _step_rows(select):
    def query(spark, folder):
        rows = select(_offline(spark, folder)).select(*_FIX, "distance_between_points")
        return _rounded(rows, 6, "distance_between_points")

    return query


def segment_speed_batch(spark, folder):
    infinite = F.coalesce(F.col("speed") == float("inf"), F.lit(False))
    rows = _offline(spark, folder).steps().withColumn("in_no_time", infinite)
    rows = rows.withColumn("speed", F.when(~F.col("in_no_time"), F.round("speed", 6)))
    rows = rows.select(
        *_FIX, "distance_between_points", "time_diff_hours", "speed", "in_no_time"
    )
    return _rounded(_rounded(rows, 6, "distance_between_points"), 9, "time_diff_hours")


def max_distances(spark, folder):
    jump = F.when(
        F.col("distance_between_points") > LIMITS.jump_km, F.col("distance_between_points")
    )
    return _offline(spark, folder).steps().agg(
        F.round(F.max(CENTRE_DISTANCE), 6).alias("max_radius_distance"),
        F.round(F.max(jump), 6).alias("max_jump_distance"),
        F.count(jump).alias("jumps"),
    )


def abnormal_jumps_all(spark, folder):
    """Jumps between distinct fixes, those outside the radius included."""
    offline = _offline(spark, folder)
    steps = motion.with_steps(offline.distinct_rows(), offline.track)
    rows = motion.abnormal_jumps(steps).select(*_FIX, "distance_between_points")
    return _rounded(rows, 6, "distance_between_points")


def very_high_speed_count(spark, folder):
    fast = motion.faster_than(_offline(spark, folder).high_speed(), LIMITS.very_high_kmh)
    return fast.agg(F.count(F.lit(1)).alias("fixes"))


def distance_over_time(spark, folder):
    staged = _offline(spark, folder).staged(_new_folder(spark, "offline"))
    rows = staged.distance_over_time().select(*_AT, "total_distance")
    return _rounded(rows, 4, "total_distance")


# -- the stream ---------------------------------------------------------------


_MESSAGE_FILES, _FILES_PER_TRIGGER = 8, 2


def write_messages(spark: SparkSession, folder: str) -> str:
    """Fixes and markers of ``folder`` as message files in a new folder: a file
    has all messages of its keys, as a topic's partition would, and the last
    one ends the input."""
    base = _new_folder(spark, "stream")
    fixes = _trips(spark, folder)
    sent = messages.encode(fixes)
    # One in 223 comes a second time with a damaged timestamp, and one in 227
    # with a place that is no number.
    seq = F.col("seq")
    no_time = sent.filter(seq % 223 == 0).withColumn(
        "value", F.regexp_replace("value", '"timestamp":"[^"]*"', '"timestamp":"bad"')
    )
    no_place = sent.filter(seq % 227 == 0).withColumn(
        "value", F.regexp_replace("value", '"longitude":[^,]*', '"longitude":"NaN"')
    )
    spread = sent.unionByName(no_time).unionByName(no_place).repartition(_MESSAGE_FILES, "key")
    spread.sortWithinPartitions("seq").write.json(f"{base}/messages")
    messages.end_of_input(fixes).coalesce(1).write.mode("append").json(f"{base}/messages")
    return base


def run_stream(spark: SparkSession, base: str, publish: Callable[[DataFrame], None] | None = None) -> LiveTables:
    """Run the live job over the message files until none is left."""
    tables = LiveTables(f"{base}/tables", publish=publish)
    source = messages.file_stream(spark, f"{base}/messages", _FILES_PER_TRIGGER)
    jobs = [
        start_live_job(
            source,
            tables,
            f"{base}/checkpoint",
            available_now=True,
            partitions=spark.sparkContext.defaultParallelism,
        ),
        start_quarantine(
            source, f"{base}/quarantine", f"{base}/checkpoint_q", available_now=True
        ),
    ]
    for job in jobs:
        job.awaitTermination()
    tables.settle(spark)
    return tables


def _stream_tables(spark: SparkSession, folder: str) -> LiveTables:
    known = _state(spark, folder)
    if known not in _streams:
        _streams[known] = run_stream(spark, write_messages(spark, folder))
    return _streams[known]


def _stream(table, *columns, rounded=None, places=6):
    def query(spark, folder):
        rows = _stream_tables(spark, folder).history(spark, table).select(*columns)
        return _rounded(rows, places, rounded) if rounded else rows

    return query


def stream_quarantine(spark, folder):
    base = _stream_tables(spark, folder).folder.removesuffix("/tables")
    return spark.read.parquet(f"{base}/quarantine").select("key", "value", "seq")


def stream_quarantine_reasons(spark, folder):
    base = _stream_tables(spark, folder).folder.removesuffix("/tables")
    return spark.read.parquet(f"{base}/quarantine").select("seq", "reason")


def stream_metrics(spark, folder):
    rows = _stream_tables(spark, folder).fleet_distance(spark)
    return _rounded(rows, 4, "total_distance")


def stream_latest_active(spark, folder):
    return _stream_tables(spark, folder).latest(spark, ACTIVE).select(*_FIX)


def _stream_latest(table, *columns, rounded=None):
    """Newest rows by key, merged from the layers of a served table."""

    def query(spark, folder):
        rows = _stream_tables(spark, folder).latest(spark, table).select(*columns)
        return _rounded(rows, 6, rounded) if rounded else rows

    return query


def _topic_tables(spark: SparkSession, folder: str) -> TopicTables:
    """The five topics as the live job publishes them, read by one stream.  Each
    batch is sent twice, as after a send that broke off at its end."""
    known = ("topics", *_state(spark, folder))
    if known not in _streams:
        base = write_messages(spark, folder)

        def twice(sent: DataFrame) -> None:
            for _ in range(2):
                messages.publish_files(sent, f"{base}/topics", "lz4")

        run_stream(spark, base, twice)
        tables = TopicTables(f"{base}/routed")
        start_router(
            messages.file_topics(spark, f"{base}/topics"),
            tables,
            f"{base}/checkpoint_r",
            available_now=True,
        ).awaitTermination()
        _streams[known] = tables
    return _streams[known]


def _stream_topic(table, *columns, rounded=None):
    def query(spark, folder):
        rows = _topic_tables(spark, folder).history(spark, table).select(*columns)
        return _rounded(rows, 6, rounded) if rounded else rows

    return query


def stream_topic_served(spark, folder):
    """Mean speeds as they are served from the topics."""
    rows = _topic_tables(spark, folder).latest(spark, AVERAGES).select(*_AT, "average_speed")
    return _rounded(rows, 6, "average_speed")


# Times that a damaged clock might send, from the first to the last year.
_STRAY_TIMES = ("0001-01-01 00:00:00", "1600-02-29 12:00:00", "9999-12-31 23:59:59")
_STRAY, _SILENCE = 1_000_000, "2 seconds"
# All messages are one batch, which takes as long as there are messages.
_AT_MOST = 24 * 3600.0


def write_silent_messages(spark: SparkSession, folder: str) -> str:
    """Messages of vehicles that fall silent: nothing ends the input, and one
    vehicle in three never sends its last end of trip.  One fix in 499 comes
    again from a vehicle of its own, at a stray time."""
    base = _new_folder(spark, "silent")
    rows = _trips(spark, folder)
    last = rows.filter("is_trip_end AND taxi_id % 3 = 0").groupBy("taxi_id").agg(F.max("ts").alias("ts"))
    kept = rows.join(last.withColumn("is_trip_end", F.lit(True)), ["taxi_id", "ts", "is_trip_end"], "left_anti")
    number = (F.floor(F.col("seq") / 499) % 3 + 1).cast("int")
    times = F.array(*[F.lit(x) for x in _STRAY_TIMES])
    stray = rows.filter("seq % 499 = 0 AND NOT is_trip_end").withColumn("taxi_id", (F.col("seq") + _STRAY).cast("int"))
    stray = messages.encode(stray).withColumn(
        "value", F.regexp_replace("value", F.lit('"timestamp":"[^"]*"'), F.concat(F.lit('"timestamp":"'), F.element_at(times, number), F.lit('"')))
    )
    sent = messages.encode(kept).unionByName(stray)
    sent.repartition(_MESSAGE_FILES, "key").sortWithinPartitions("seq").write.json(f"{base}/messages")
    return base


def run_silent(spark: SparkSession, base: str) -> LiveTables:
    """Run the endless job until its timers have released what is left, and stop it."""
    tables = LiveTables(f"{base}/tables")
    source = messages.file_stream(spark, f"{base}/messages", _MESSAGE_FILES)
    job = start_live_job(
        source, tables, f"{base}/checkpoint", partitions=spark.sparkContext.defaultParallelism, silence=_SILENCE
    )
    try:
        wait_until_silent(job, _SILENCE, _AT_MOST)
    finally:
        job.stop()
    return tables


def _silent_tables(spark: SparkSession, folder: str) -> LiveTables:
    known = ("silent", *_state(spark, folder))
    if known not in _streams:
        _streams[known] = run_silent(spark, write_silent_messages(spark, folder))
    return _streams[known]


def stream_silent_active(spark, folder):
    rows = _silent_tables(spark, folder).history(spark, ACTIVE).filter(F.col("taxi_id") < _STRAY)
    return _rounded(rows.select(*_FIX, _DISTANCE, "is_violated"), 6, _DISTANCE)


def stream_silent_ended(spark, folder):
    return _silent_tables(spark, folder).history(spark, ENDED).select(*_AT, "ended_trip_count")


def stream_silent_latest_active(spark, folder):
    """Vehicles still active: those without their last end of trip."""
    return _silent_tables(spark, folder).latest(spark, ACTIVE).filter(F.col("taxi_id") < _STRAY).select(*_FIX)


def stream_poison(spark, folder):
    """Fixes at stray times, their times as text."""
    rows = _silent_tables(spark, folder).history(spark, ACTIVE).filter(F.col("taxi_id") >= _STRAY)
    rows = rows.withColumn("time", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    return _rounded(rows.select("taxi_id", "time", "seq", "longitude", "latitude", _DISTANCE), 6, _DISTANCE)


def _resumed_tables(spark: SparkSession, folder: str) -> LiveTables:
    """A stream over the second half of the messages that begins where a batch
    analysis of the first half ended."""
    known = ("resumed", *_state(spark, folder))
    if known not in _streams:
        base = _new_folder(spark, "resumed")
        # Both halves are read several times each; the markers are found once.
        _trips(spark, folder).drop("source_file").write.parquet(f"{base}/trips")
        rows = spark.read.parquet(f"{base}/trips")
        cut = rows.agg(F.floor(F.max("seq") / 16) * 8).first()[0] or 0
        first, second = rows.filter(F.col("seq") < cut), rows.filter(F.col("seq") >= cut)
        past = LiveAnalysis(first)
        tables = LiveTables(f"{base}/tables")
        tables.begin(past)
        sent = messages.encode(second).repartition(_MESSAGE_FILES, "key").sortWithinPartitions("seq")
        sent.write.json(f"{base}/messages")
        messages.end_of_input(rows).coalesce(1).write.mode("append").json(f"{base}/messages")
        starting_state(past).write.parquet(f"{base}/state")
        start_live_job(
            messages.file_stream(spark, f"{base}/messages", _FILES_PER_TRIGGER),
            tables,
            f"{base}/checkpoint",
            available_now=True,
            partitions=spark.sparkContext.defaultParallelism,
            initial=spark.read.parquet(f"{base}/state"),
        ).awaitTermination()
        _streams[known] = tables
    return _streams[known]


def stream_resumed_averages(spark, folder):
    rows = _resumed_tables(spark, folder).history(spark, AVERAGES).select(*_AT, "average_speed")
    return _rounded(rows, 6, "average_speed")


def stream_resumed_metrics(spark, folder):
    return _rounded(_resumed_tables(spark, folder).fleet_distance(spark), 4, "total_distance")


def stream_resumed_ended(spark, folder):
    return _resumed_tables(spark, folder).history(spark, ENDED).select(*_AT, "ended_trip_count")


def stream_resumed_served(spark, folder):
    """Served mean speeds: every vehicle, also those the stream never heard of."""
    rows = _resumed_tables(spark, folder).latest(spark, AVERAGES).select(*_AT, "average_speed")
    return _rounded(rows, 6, "average_speed")


def queries() -> dict[str, Query]:
    return {
        "scan_fixes": read_event_fixes,
        "processed_table": processed_table,
        "csv_export": csv_export,
        "parse_valid": parse_valid,
        "parse_rejects": parse_rejects,
        "incremental_table": incremental_table,
        "trip_end_rows": lambda s, d: trips.split_markers(_trips(s, d))[1],
        "fixes_with_trip_end": _trips,
        "json_encode": lambda s, d: messages.encode(_fixes(s, d)),
        "json_decode": json_decode,
        "topic_union": topic_union,
        "topic_active": _topic(ACTIVE, _DISTANCE),
        "topic_speeds": _topic(SPEEDS, "speed"),
        "topic_averages": _topic(AVERAGES, "average_speed"),
        "topic_metrics": _topic(METRICS, "total_distance", 4),
        "topic_ended": _topic(ENDED),
        "time_slice": lambda s, d: replay.time_slice(
            _fixes(s, d), "2008-02-02 13:40:00", "2008-02-02 15:00:00"
        ).select(*_FIX),
        "replay_slices": lambda s, d: replay.replay_slices(
            _fixes(s, d), "2008-02-02 13:36:08", "2008-02-02 14:59:59", 60
        ).select(*_FIX, "slice_id"),
        "geo_distance": geo_distance,
        "event_time_ms": lambda s, d: _fixes(s, d).select(
            "taxi_id", "seq", event_time_ms(F.col("ts")).alias("event_time_ms")
        ),
        "geofence_active": geofence_active,
        "geofence_band_counts": geofence_band_counts,
        "clean_fixes": lambda s, d: _live(s, d).cleaned().select(*_FIX),
        "clean_fixes_sliced": lambda s, d: _sliced(s, d).cleaned().select(*_FIX),
        "segment_speed_sliced": segment_speed_sliced,
        "avg_speed_running_sliced": avg_speed_running_sliced,
        "fleet_running_distance_sliced": fleet_running_distance_sliced,
        "clean_rejects": clean_rejects,
        "clean_as_wired": clean_as_wired,
        "active_taxi": active_taxi,
        "segment_distance": segment_distance,
        "segment_speed": segment_speed,
        "speeding_counts": speeding_counts,
        "speed_history": speed_history,
        "taxi_running_distance": _averages("taxi_distance", 4),
        "taxi_total_distance": taxi_total_distance,
        "taxi_elapsed_time": _averages("elapsed_seconds", 4),
        "avg_speed_running": _averages("average_speed", 6),
        "avg_speed_final": avg_speed_final,
        "fleet_running_distance": fleet_running_distance,
        "fleet_total_distance": fleet_total_distance,
        "ended_running": ended_running,
        "ended_fleet": lambda s, d: trips.ended_fleet(_trips(s, d)),
        "ended_as_wired": ended_as_wired,
        "latest_active": latest_active,
        "latest_active_open": latest_active_open,
        "latest_fleet_total": latest_fleet_total,
        "latest_speed": latest_speed,
        "latest_avg_speed": latest_avg_speed,
        "latest_ended": latest_ended,
        "serve_active_doc": serve_active_doc,
        "serve_metrics_doc": serve_metrics_doc,
        "dedupe_rows": lambda s, d: _offline(s, d).distinct_rows().drop("is_trip_end"),
        "split_counts": split_counts,
        "dup_groups": lambda s, d: _offline(s, d).repeated_times().select(*_FIX),
        "dup_counts_by_taxi": lambda s, d: explore.value_counts(
            _offline(s, d).repeated_times(), "taxi_id"
        ),
        "dup_times_one_taxi": dup_times_one_taxi,
        "radius_filter": radius_filter,
        "lag_columns": lag_columns,
        "segment_distance_batch": _step_rows(OfflineAnalysis.steps),
        "segment_speed_batch": segment_speed_batch,
        "abnormal_jumps": _step_rows(OfflineAnalysis.abnormal_jumps),
        "max_distances": max_distances,
        "abnormal_jumps_all": abnormal_jumps_all,
        "high_speed": _step_rows(OfflineAnalysis.high_speed),
        "very_high_speed_count": very_high_speed_count,
        "distance_over_time": distance_over_time,
        "sorted_fixes": lambda s, d: explore.sorted_by_time(_fixes(s, d)).select(*_FIX),
        "head_fixes": lambda s, d: explore.head(_fixes(s, d)).select(*_FIX),
        "profile_fixes": lambda s, d: explore.profile(_fixes(s, d)),
        "stream_active": _stream(
            ACTIVE, *_FIX, _DISTANCE, "is_violated", rounded=_DISTANCE
        ),
        "stream_speeds": _stream(SPEEDS, *_FIX, "speed", "is_speeding", rounded="speed"),
        "stream_averages": _stream(
            AVERAGES, *_AT, "average_speed", rounded="average_speed"
        ),
        "stream_metrics": stream_metrics,
        "stream_ended": _stream(ENDED, *_AT, "ended_trip_count"),
        "stream_rejects": _stream(REJECTS, *_AT, "reject_reason"),
        "stream_quarantine": stream_quarantine,
        "stream_latest_active": stream_latest_active,
        "stream_latest_speeds": _stream_latest(SPEEDS, *_AT, "speed", rounded="speed"),
        "stream_latest_averages": _stream_latest(AVERAGES, *_AT, "average_speed", rounded="average_speed"),
        "stream_latest_ended": _stream_latest(ENDED, "ended_trip_count"),
        "stream_topic_active": _stream_topic(ACTIVE, *_FIX, _DISTANCE, "is_violated", rounded=_DISTANCE),
        "stream_topic_speeds": _stream_topic(SPEEDS, *_FIX, "speed", "is_speeding", rounded="speed"),
        "stream_topic_averages": _stream_topic(AVERAGES, *_AT, "average_speed", rounded="average_speed"),
        "stream_topic_metrics": _stream_topic(METRICS, *_AT),
        "stream_topic_ended": _stream_topic(ENDED, *_AT, "ended_trip_count"),
        "stream_topic_served": stream_topic_served,
        "stream_quarantine_reasons": stream_quarantine_reasons,
        "stream_silent_active": stream_silent_active,
        "stream_silent_ended": stream_silent_ended,
        "stream_silent_latest_active": stream_silent_latest_active,
        "stream_poison": stream_poison,
        "stream_resumed_averages": stream_resumed_averages,
        "stream_resumed_metrics": stream_resumed_metrics,
        "stream_resumed_ended": stream_resumed_ended,
        "stream_resumed_served": stream_resumed_served,
    }
