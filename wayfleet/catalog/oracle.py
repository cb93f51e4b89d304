"""Every registered query as SQL text, for comparison in another engine.

Written from the definitions, not from the Spark plans: the cleaning fold is a
recursive query, windows are per vehicle, totals are plain window sums.
"""

from __future__ import annotations


def _km(lat_a: str, lon_a: str, lat_b: str, lon_b: str) -> str:
    half_lat = f"sin(radians({lat_b} - {lat_a}) / 2)"
    half_lon = f"sin(radians({lon_b} - {lon_a}) / 2)"
    # Chords of the data stay below 1; ``least`` would turn NULL into a distance.
    return (
        "(12745.6 * asin(sqrt("
        f"{half_lat} * {half_lat} + cos(radians({lat_a})) * cos(radians({lat_b}))"
        f" * {half_lon} * {half_lon})))"
    )


_CENTRE = ("39.9163447::DOUBLE", "116.3971556::DOUBLE")
_TO_CENTRE = _km("latitude", "longitude", *_CENTRE)
_STEP = _km("p_lat", "p_lon", "latitude", "longitude")
_SECONDS = "(epoch_us(ts) - epoch_us(p_ts)) / 1e6"

_FIXES = """
fixes AS (
  SELECT CAST(user_id AS INTEGER) AS taxi_id,
         TIMESTAMP '2008-02-02 13:30:00' + to_seconds((event_id // 8) * 8) AS ts,
         116.3971556::DOUBLE + ((user_id * 7919) % 240 - 120) / 1000.0::DOUBLE
           + ((event_id * 37) % 41 - 20) / 1000.0::DOUBLE
           + CASE WHEN event_id % 97 = 0 THEN 2.0::DOUBLE ELSE 0.0::DOUBLE END AS longitude,
         39.9163447::DOUBLE + ((user_id * 104729) % 200 - 100) / 1000.0::DOUBLE
           + ((event_id * 53) % 31 - 15) / 1000.0::DOUBLE AS latitude,
         event_id AS seq,
         false AS is_trip_end
  FROM events)"""

_FILES = """
logged AS (
  SELECT *, taxi_id || '_' || strftime(ts, '%Y%m%d%H') || '.txt' AS source_file FROM fixes),
ends AS (
  SELECT taxi_id, max(ts) AS ts, -1.0::DOUBLE AS longitude, -1.0::DOUBLE AS latitude,
         max(seq) AS seq, true AS is_trip_end, source_file
  FROM logged GROUP BY source_file, taxi_id),
trips AS (SELECT * FROM logged UNION ALL BY NAME SELECT * FROM ends)"""

_RAW = """
raw AS (SELECT * FROM fixes UNION ALL SELECT * FROM fixes WHERE seq % 50 = 0)"""

_DISTINCT = """
distinct_rows AS (
  SELECT taxi_id, ts, longitude, latitude, min(seq) AS seq FROM raw GROUP BY ALL)"""

_STEPS = f"""
radius AS (
  SELECT *, {_TO_CENTRE} AS distance_from_forbidden_city FROM distinct_rows
  WHERE {_TO_CENTRE} <= 15),
shifted AS (
  SELECT *, lag(latitude) OVER w AS p_lat, lag(longitude) OVER w AS p_lon,
         lag(ts) OVER w AS p_ts
  FROM radius WINDOW w AS (PARTITION BY taxi_id ORDER BY ts, seq)),
measured AS (
  SELECT *, {_STEP} AS km, {_SECONDS} / 3600 AS hours FROM shifted),
steps AS (
  SELECT *, CASE WHEN hours > 0 THEN km / hours
                 WHEN hours = 0 AND km > 0 THEN 'infinity'::DOUBLE END AS speed
  FROM measured)"""


def _screened(source: str) -> str:
    step = _km("f.a_lat", "f.a_lon", "o.latitude", "o.longitude")
    passed = "(epoch_us(o.ts) - epoch_us(f.a_ts)) / 1e6"
    return f"""
ordered AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY taxi_id ORDER BY ts, is_trip_end, seq) AS rn
  FROM {source}),
fold AS (
  SELECT taxi_id, rn, latitude AS a_lat, longitude AS a_lon, ts AS a_ts,
         NULL::VARCHAR AS reject_reason
  FROM ordered WHERE rn = 1
  UNION ALL
  SELECT taxi_id, rn,
         CASE WHEN reason IS NULL THEN latitude ELSE a_lat END,
         CASE WHEN reason IS NULL THEN longitude ELSE a_lon END,
         CASE WHEN reason IS NULL THEN ts ELSE a_ts END,
         reason
  FROM (SELECT o.taxi_id, o.rn, o.latitude, o.longitude, o.ts, f.a_lat, f.a_lon, f.a_ts,
               CASE WHEN o.ts = f.a_ts AND NOT o.is_trip_end THEN 'duplicate_time'
                    WHEN o.ts > f.a_ts AND {step} / ({passed}) * 3600 > 300
                    THEN 'impossible_speed' END AS reason
        FROM fold f JOIN ordered o ON o.taxi_id = f.taxi_id AND o.rn = f.rn + 1)),
screened AS (
  SELECT o.*, f.reject_reason FROM ordered o JOIN fold f USING (taxi_id, rn))"""


_ACTIVE = f"""
active AS (
  SELECT *, {_TO_CENTRE} AS km_out FROM screened
  WHERE reject_reason IS NULL AND {_TO_CENTRE} <= 15),
chained AS (
  SELECT *, lag(latitude) OVER w AS p_lat, lag(longitude) OVER w AS p_lon,
         lag(ts) OVER w AS p_ts
  FROM active WINDOW w AS (PARTITION BY taxi_id ORDER BY ts, is_trip_end, seq)),
spans AS (SELECT *, {_STEP} AS segment_km, {_SECONDS} AS seconds FROM chained),
segments AS (
  SELECT *, CASE WHEN p_ts IS NULL THEN NULL WHEN seconds > 0
                 THEN segment_km / seconds * 3600 ELSE 0.0::DOUBLE END AS speed
  FROM spans)"""

_SO_FAR = "OVER (PARTITION BY taxi_id ORDER BY ts, is_trip_end, seq ROWS UNBOUNDED PRECEDING)"
_FLEET_SO_FAR = "OVER (ORDER BY ts, taxi_id, seq ROWS UNBOUNDED PRECEDING)"
_BAND = "CASE WHEN km_out > 10 AND km_out <= 15 THEN 1 ELSE 0 END"
_FIX = "taxi_id, ts, longitude, latitude, seq"


def _sql(ctes: list[str], body: str) -> str:
    return "WITH RECURSIVE" + ",".join(ctes) + "\n" + body.strip()


_LIVE = [_FIXES, _screened("fixes"), _ACTIVE]
_STREAM = [
    _FIXES,
    _FILES,
    "\nmoving AS (SELECT * FROM trips WHERE NOT is_trip_end)",
    _screened("moving"),
    _ACTIVE,
]
_OFFLINE = [_FIXES, _RAW, _DISTINCT, _STEPS]

_LINES = """
lines AS (
  SELECT seq,
         taxi_id || ',' || CASE WHEN seq % 223 = 0 THEN 'bad'
                                ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END
           || ',' || CASE WHEN seq % 227 = 0 THEN 'NaN' WHEN seq % 229 = 0 THEN 'Infinity'
                          ELSE CAST(longitude AS VARCHAR) END || CASE WHEN seq % 211 = 0 THEN '' ELSE ',' || latitude END
           AS value
  FROM fixes)"""

_MESSAGE = """'{"taxi_id":' || taxi_id || ',"timestamp":"' ||
         strftime(ts, '%Y-%m-%d %H:%M:%S') || '","longitude":' || longitude ||
         ',"latitude":' || latitude || '}'"""


def _latest(source: str, keys: str = "PARTITION BY taxi_id ") -> str:
    return f"""
ranked AS (
  SELECT *, row_number() OVER ({keys}ORDER BY ts DESC, is_trip_end DESC, seq DESC) AS nth
  FROM {source})"""


def _active_outputs(ctes: list[str]) -> dict[str, str]:
    """The five live outputs over a given source."""
    return {
        "active": _sql(
            ctes,
            f"""SELECT {_FIX}, round(km_out, 6) AS distance_to_forbidden_city,
                       {_BAND} AS is_violated FROM active""",
        ),
        "speeds": _sql(
            ctes,
            f"""SELECT {_FIX}, round(speed, 6) AS speed,
                       CASE WHEN speed > 50 THEN 1 ELSE 0 END AS is_speeding
                FROM segments WHERE segment_km IS NOT NULL""",
        ),
        "averages": _sql(
            ctes,
            f"""SELECT taxi_id, ts, seq,
                       round(coalesce(avg(speed) {_SO_FAR}, 0), 6) AS average_speed
                FROM segments""",
        ),
        "metrics": _sql(
            ctes,
            f"""SELECT taxi_id, ts, seq, round(sum(segment_km) {_FLEET_SO_FAR}, 4)
                       AS total_distance
                FROM segments WHERE segment_km IS NOT NULL""",
        ),
    }


def oracle_sql() -> dict[str, str]:
    live = _active_outputs(_LIVE)
    stream = _active_outputs(_STREAM)
    trips = [_FIXES, _FILES]
    ended = f"SELECT taxi_id, ts, seq, row_number() {_SO_FAR} AS ended_trip_count FROM"
    jumps = "FROM steps WHERE km > 15"
    step_columns = f"{_FIX}, round(km, 6) AS distance_between_points"
    sql = {
        # sources
        "scan_fixes": _sql([_FIXES], "SELECT * FROM fixes"),
        "processed_table": _sql([*trips], "SELECT * EXCLUDE (source_file) FROM trips"),
        "csv_export": _sql(
            _OFFLINE,
            f"""SELECT taxi_id, ts, seq, round(total_distance, 4) AS total_distance FROM (
                  SELECT *, sum(coalesce(km, 0)) OVER w AS total_distance,
                         row_number() OVER w AS nth
                  FROM steps WINDOW w AS (ORDER BY taxi_id, ts, seq ROWS UNBOUNDED PRECEDING))
                WHERE nth > 1""",
        ),
        "parse_valid": _sql(
            [_FIXES],
            f"""SELECT taxi_id, ts, longitude, latitude, is_trip_end FROM fixes
                WHERE seq % 211 <> 0 AND seq % 223 <> 0 AND seq % 227 <> 0 AND seq % 229 <> 0""",
        ),
        "parse_rejects": _sql(
            [_FIXES, _LINES],
            "SELECT value FROM lines WHERE seq % 211 = 0 OR seq % 223 = 0 OR seq % 227 = 0 OR seq % 229 = 0",
        ),
        "trip_end_rows": _sql(trips, "SELECT * FROM ends"),
        "fixes_with_trip_end": _sql(trips, "SELECT * FROM trips"),
        "json_encode": _sql(
            [_FIXES],
            f"SELECT CAST(taxi_id AS VARCHAR) AS key, {_MESSAGE} AS value, seq FROM fixes",
        ),
        "json_decode": _sql([_FIXES], "SELECT * FROM fixes"),
        # projections and filters
        "time_slice": _sql(
            [_FIXES],
            f"""SELECT {_FIX} FROM fixes WHERE ts >= TIMESTAMP '2008-02-02 13:40:00'
                AND ts < TIMESTAMP '2008-02-02 15:00:00'""",
        ),
        "replay_slices": _sql(
            [_FIXES],
            f"""SELECT {_FIX},
                       (epoch_us(ts) - epoch_us(TIMESTAMP '2008-02-02 13:36:08')) // 60000000
                         AS slice_id
                FROM fixes
                WHERE ts >= TIMESTAMP '2008-02-02 13:36:08'
                  AND ts < TIMESTAMP '2008-02-02 15:00:08'""",
        ),
        "geo_distance": _sql(
            [_FIXES],
            f"SELECT taxi_id, seq, round({_TO_CENTRE}, 6) AS distance_km FROM fixes",
        ),
        "event_time_ms": _sql(
            [_FIXES], "SELECT taxi_id, seq, epoch_ms(ts) AS event_time_ms FROM fixes"
        ),
        "geofence_active": _sql(
            [_FIXES],
            f"""SELECT {_FIX}, round(km_out, 6) AS distance_to_forbidden_city,
                       {_BAND} AS is_violated
                FROM (SELECT *, {_TO_CENTRE} AS km_out FROM fixes) WHERE km_out <= 15""",
        ),
        "geofence_band_counts": _sql(
            [_FIXES],
            f"""SELECT {_BAND} AS is_violated, count(*) AS fixes,
                       count(DISTINCT taxi_id) AS taxis, round(max(km_out), 6) AS max_distance
                FROM (SELECT *, {_TO_CENTRE} AS km_out FROM fixes)
                WHERE km_out <= 15 GROUP BY 1""",
        ),
        # cleaning
        "clean_fixes": _sql(
            _LIVE[:2], f"SELECT {_FIX} FROM screened WHERE reject_reason IS NULL"
        ),
        "clean_rejects": _sql(
            _LIVE[:2],
            f"SELECT {_FIX}, reject_reason FROM screened WHERE reject_reason IS NOT NULL",
        ),
        "clean_as_wired": _sql(
            [*trips, _screened("trips")],
            f"SELECT {_FIX}, is_trip_end, reject_reason FROM screened",
        ),
        # live analysis
        "active_taxi": live["active"],
        "segment_distance": _sql(
            _LIVE,
            f"""SELECT {_FIX}, round(segment_km, 6) AS segment_km
                FROM segments WHERE segment_km IS NOT NULL""",
        ),
        "segment_speed": live["speeds"],
        "speeding_counts": _sql(
            _LIVE,
            """SELECT CASE WHEN speed > 50 THEN 1 ELSE 0 END AS is_speeding,
                      count(*) AS segments, count(DISTINCT taxi_id) AS taxis
               FROM segments WHERE segment_km IS NOT NULL GROUP BY 1""",
        ),
        "speed_history": _sql(
            _LIVE,
            """SELECT taxi_id, (nth - 1) // 20 AS page, count(*) AS n_speeds,
                      string_agg(CAST(CAST(round(speed * 1000) AS BIGINT) AS VARCHAR), ','
                                 ORDER BY nth) AS speeds_m_per_h
               FROM (SELECT *, row_number() OVER (PARTITION BY taxi_id
                               ORDER BY ts, is_trip_end, seq) AS nth
                     FROM segments WHERE segment_km IS NOT NULL)
               GROUP BY 1, 2""",
        ),
        "taxi_running_distance": _sql(
            _LIVE,
            f"""SELECT taxi_id, ts, seq,
                       round(sum(coalesce(segment_km, 0)) {_SO_FAR}, 4) AS taxi_distance
                FROM segments""",
        ),
        "taxi_total_distance": _sql(
            _LIVE,
            """SELECT taxi_id, round(sum(coalesce(segment_km, 0)), 4) AS taxi_distance,
                      count(segment_km) AS segments
               FROM segments GROUP BY 1""",
        ),
        "taxi_elapsed_time": _sql(
            _LIVE,
            f"""SELECT taxi_id, ts, seq,
                       round(sum(coalesce(seconds, 0)) {_SO_FAR}, 4) AS elapsed_seconds
                FROM segments""",
        ),
        "avg_speed_running": live["averages"],
        "avg_speed_final": _sql(
            _LIVE,
            """SELECT taxi_id, round(coalesce(avg(speed), 0), 6) AS average_speed
               FROM segments GROUP BY 1""",
        ),
        "fleet_running_distance": live["metrics"],
        "fleet_total_distance": _sql(
            _LIVE,
            "SELECT round(coalesce(sum(segment_km), 0), 4) AS total_distance FROM segments",
        ),
        "ended_running": _sql(trips, f"{ended} ends"),
        "ended_fleet": _sql(trips, "SELECT count(*) AS ended_trip_count FROM ends"),
        "ended_as_wired": _sql(
            [*trips, _screened("trips")],
            f"""SELECT count(*) AS ended_trip_count FROM screened
                WHERE reject_reason IS NULL AND is_trip_end AND {_TO_CENTRE} <= 15""",
        ),
        # served tables
        "latest_active": _sql(
            [*_LIVE, _latest("active")],
            f"""SELECT {_FIX}, round(km_out, 6) AS distance_to_forbidden_city,
                       {_BAND} AS is_violated FROM ranked WHERE nth = 1""",
        ),
        "latest_active_open": _sql(
            [
                *_LIVE,
                f"""
moved AS (
  SELECT {_FIX}, is_trip_end FROM active
  UNION ALL
  SELECT taxi_id, max(ts), -1.0, -1.0, max(seq), true FROM fixes GROUP BY taxi_id
  HAVING max(ts) < (SELECT max(ts) FROM fixes) - INTERVAL 60 SECOND)""",
                _latest("moved"),
            ],
            f"SELECT {_FIX} FROM ranked WHERE nth = 1 AND NOT is_trip_end",
        ),
        "latest_fleet_total": _sql(
            _LIVE,
            f"""SELECT taxi_id, ts, seq, round(total_distance, 4) AS total_distance FROM (
                  SELECT *, sum(segment_km) {_FLEET_SO_FAR} AS total_distance,
                         row_number() OVER (ORDER BY ts DESC, taxi_id DESC, seq DESC) AS nth
                  FROM segments WHERE segment_km IS NOT NULL) WHERE nth = 1""",
        ),
        "latest_speed": _sql(
            [
                *_LIVE,
                "\nmoved AS (SELECT * FROM segments WHERE segment_km IS NOT NULL)",
                _latest("moved"),
            ],
            f"""SELECT {_FIX}, round(speed, 6) AS speed,
                       CASE WHEN speed > 50 THEN 1 ELSE 0 END AS is_speeding,
                       'Taxi ' || taxi_id AS taxi_description
                FROM ranked WHERE nth = 1""",
        ),
        "latest_avg_speed": _sql(
            [
                *_LIVE,
                f"""
means AS (
  SELECT *, coalesce(avg(speed) {_SO_FAR}, 0) AS average_speed FROM segments)""",
                _latest("means"),
            ],
            """SELECT taxi_id, ts, seq, round(average_speed, 6) AS average_speed,
                      'Taxi ' || taxi_id AS taxi_description
               FROM ranked WHERE nth = 1""",
        ),
        "latest_ended": _sql(
            [
                *trips,
                f"\ncounted AS (SELECT *, row_number() {_SO_FAR} AS ended_trip_count FROM ends)",
                _latest("counted", ""),
            ],
            "SELECT ended_trip_count FROM ranked WHERE nth = 1",
        ),
        "serve_active_doc": _sql(
            [*_LIVE, _latest("active")],
            f"""SELECT taxi_id, ts, seq, longitude AS location_lon, latitude AS location_lat,
                       round(km_out, 6) AS distance_to_forbidden_city,
                       {_BAND} AS is_violated, 'Taxi ' || taxi_id AS taxi_description,
                       CASE WHEN {_BAND} = 0 THEN 'Taxi operating within permitted area'
                            ELSE 'Taxi has entered a restricted area' END AS is_violated_text
                FROM ranked WHERE nth = 1""",
        ),
        "serve_metrics_doc": _sql(
            _LIVE,
            """SELECT CAST(trunc(sum(segment_km)) AS BIGINT) AS total_distance,
                      CAST(CAST(trunc(sum(segment_km)) AS BIGINT) AS VARCHAR) || ' Km'
                        AS total_distance_string
               FROM segments""",
        ),
        "topic_union": _sql(
            [
                *_LIVE,
                f"""
tagged AS (
  SELECT 'active_taxi' AS topic, taxi_id, seq FROM active
  UNION ALL SELECT 'over_speeding', taxi_id, seq FROM segments WHERE segment_km IS NOT NULL
  UNION ALL SELECT 'avg_speed', taxi_id, seq FROM segments
  UNION ALL SELECT 'metrics', taxi_id, seq FROM segments WHERE segment_km IS NOT NULL
  UNION ALL SELECT 'ended_taxi', taxi_id, max(seq) FROM fixes
    GROUP BY taxi_id, date_trunc('hour', ts))""",
            ],
            """SELECT topic, count(*) AS messages, count(DISTINCT taxi_id) AS taxis,
                      CAST(sum(seq) AS BIGINT) AS seq_sum
               FROM tagged GROUP BY 1""",
        ),
        # offline analysis
        "dedupe_rows": _sql(_OFFLINE[:3], "SELECT * FROM distinct_rows"),
        "split_counts": _sql(
            [*trips],
            """SELECT is_trip_end, count(*) AS fixes, count(DISTINCT taxi_id) AS taxis
               FROM trips GROUP BY 1""",
        ),
        "dup_groups": _sql(
            _OFFLINE[:3],
            f"""SELECT {_FIX} FROM (
                  SELECT *, count(*) OVER (PARTITION BY taxi_id, ts) AS n FROM distinct_rows)
                WHERE n > 1""",
        ),
        "dup_counts_by_taxi": _sql(
            _OFFLINE[:3],
            """SELECT taxi_id, count(*) AS count FROM (
                 SELECT *, count(*) OVER (PARTITION BY taxi_id, ts) AS n FROM distinct_rows)
               WHERE n > 1 GROUP BY 1""",
        ),
        "dup_times_one_taxi": _sql(
            _OFFLINE[:3],
            """SELECT ts, count(*) AS count FROM (
                 SELECT *, count(*) OVER (PARTITION BY taxi_id, ts) AS n FROM distinct_rows)
               WHERE n > 1 AND taxi_id = 7 GROUP BY 1""",
        ),
        "radius_filter": _sql(
            _OFFLINE,
            f"""SELECT {_FIX}, round(distance_from_forbidden_city, 6)
                       AS distance_from_forbidden_city FROM radius""",
        ),
        "lag_columns": _sql(
            _OFFLINE,
            f"""SELECT {_FIX}, p_lat AS previous_latitude, p_lon AS previous_longitude,
                       p_ts AS previous_timestamp FROM shifted""",
        ),
        "segment_distance_batch": _sql(_OFFLINE, f"SELECT {step_columns} FROM steps"),
        "segment_speed_batch": _sql(
            _OFFLINE,
            f"""SELECT {step_columns}, round(hours, 9) AS time_diff_hours,
                       CASE WHEN isinf(speed) THEN NULL ELSE round(speed, 6) END AS speed,
                       coalesce(isinf(speed), false) AS in_no_time
                FROM steps""",
        ),
        "abnormal_jumps": _sql(_OFFLINE, f"SELECT {step_columns} {jumps}"),
        "abnormal_jumps_all": _sql(
            [*_OFFLINE[:3], _STEPS.replace(f"WHERE {_TO_CENTRE} <= 15", "")],
            f"SELECT {step_columns} {jumps}",
        ),
        "max_distances": _sql(
            _OFFLINE,
            f"""SELECT (SELECT round(max(distance_from_forbidden_city), 6) FROM radius)
                         AS max_radius_distance,
                       round(max(CASE WHEN km > 15 THEN km END), 6) AS max_jump_distance,
                       count(CASE WHEN km > 15 THEN 1 END) AS jumps
                FROM steps""",
        ),
        "high_speed": _sql(_OFFLINE, f"SELECT {step_columns} FROM steps WHERE speed > 50"),
        "very_high_speed_count": _sql(
            _OFFLINE, "SELECT count(*) AS fixes FROM steps WHERE speed > 150"
        ),
        "distance_over_time": _sql(
            _OFFLINE,
            f"""SELECT taxi_id, ts, seq, round(total_distance, 4) AS total_distance FROM (
                  SELECT *, sum(coalesce(km, 0)) OVER w AS total_distance,
                         row_number() OVER w AS nth
                  FROM steps WINDOW w AS (ORDER BY taxi_id, ts, seq ROWS UNBOUNDED PRECEDING))
                WHERE nth > 1""",
        ),
        "sorted_fixes": _sql([_FIXES], f"SELECT {_FIX} FROM fixes ORDER BY ts, seq"),
        "head_fixes": _sql([_FIXES], f"SELECT {_FIX} FROM fixes ORDER BY ts, seq LIMIT 5"),
        "profile_fixes": _sql(
            [_FIXES],
            " UNION ALL ".join(
                f"SELECT {i} AS position, '{c}' AS column_name, '{t}' AS column_type, "
                f"count({c}) AS non_null, count(*) - count({c}) AS nulls FROM fixes"
                for i, (c, t) in enumerate(
                    [
                        ("taxi_id", "int"),
                        ("ts", "timestamp"),
                        ("longitude", "double"),
                        ("latitude", "double"),
                        ("seq", "bigint"),
                        ("is_trip_end", "boolean"),
                    ]
                )
            ),
        ),
        # the stream, to the end of its input
        "stream_active": stream["active"],
        "stream_speeds": stream["speeds"],
        "stream_averages": stream["averages"],
        "stream_metrics": stream["metrics"],
        "stream_ended": _sql(
            _STREAM[:2], f"{ended} trips WHERE is_trip_end"
        ),
        "stream_rejects": _sql(
            _STREAM,
            "SELECT taxi_id, ts, seq, reject_reason FROM screened WHERE reject_reason IS NOT NULL",
        ),
        "stream_quarantine": _sql(
            _STREAM[:2],
            f"""SELECT CAST(taxi_id AS VARCHAR) AS key,
                       replace({_MESSAGE}, strftime(ts, '%Y-%m-%d %H:%M:%S'), 'bad') AS value,
                       seq
                FROM trips WHERE seq % 223 = 0
                UNION ALL
                SELECT CAST(taxi_id AS VARCHAR) AS key,
                       regexp_replace({_MESSAGE}, '"longitude":[^,]*', '"longitude":"NaN"') AS value,
                       seq
                FROM trips WHERE seq % 227 = 0""",
        ),
        "stream_latest_active": _sql(
            [
                *_STREAM,
                f"""
moved AS (
  SELECT {_FIX}, is_trip_end FROM active
  UNION ALL
  SELECT {_FIX}, is_trip_end FROM trips WHERE is_trip_end)""",
                _latest("moved"),
            ],
            f"SELECT {_FIX} FROM ranked WHERE nth = 1 AND NOT is_trip_end",
        ),
    }
    # Vehicles that fall silent: the same fixes, some last ends of trip missing.
    sent_ends = """
last_ends AS (SELECT taxi_id, max(ts) AS ts FROM trips WHERE is_trip_end AND taxi_id % 3 = 0 GROUP BY taxi_id),
sent_ends AS (
  SELECT * FROM trips t WHERE is_trip_end
    AND NOT EXISTS (SELECT 1 FROM last_ends l WHERE l.taxi_id = t.taxi_id AND l.ts = t.ts))"""
    sql["stream_silent_active"] = sql["stream_active"]
    sql["stream_silent_ended"] = _sql([*_STREAM[:2], sent_ends], f"{ended} sent_ends")
    sql["stream_silent_latest_active"] = _sql(
        [
            *_STREAM,
            sent_ends,
            f"""
moved AS (
  SELECT {_FIX}, is_trip_end FROM active
  UNION ALL
  SELECT {_FIX}, is_trip_end FROM sent_ends)""",
            _latest("moved"),
        ],
        f"SELECT {_FIX} FROM ranked WHERE nth = 1 AND NOT is_trip_end",
    )
    sql["stream_poison"] = _sql(
        [_FIXES],
        f"""SELECT CAST(seq + 1000000 AS INTEGER) AS taxi_id,
                   ['0001-01-01 00:00:00', '1600-02-29 12:00:00', '9999-12-31 23:59:59'][seq // 499 % 3 + 1] AS time,
                   seq, longitude, latitude, round({_TO_CENTRE}, 6) AS distance_to_forbidden_city
            FROM fixes WHERE seq % 499 = 0 AND {_TO_CENTRE} <= 15""",
    )
    sql["stream_quarantine_reasons"] = _sql(
        _STREAM[:2],
        """SELECT seq, 'no_time' AS reason FROM trips WHERE seq % 223 = 0
           UNION ALL SELECT seq, 'no_place' FROM trips WHERE seq % 227 = 0""",
    )
    # A stream that goes on from a batch over the first half of the fixes.
    for name in ("averages", "metrics", "ended"):
        sql[f"stream_resumed_{name}"] = (
            f"SELECT * FROM ({sql[f'stream_{name}']}) WHERE seq >= (SELECT max(event_id) // 16 * 8 FROM events)"
        )
    # One log file per vehicle and half of the time, each with its marker.
    sql["incremental_table"] = _sql(
        [_FIXES],
        """SELECT taxi_id, ts, longitude, latitude, is_trip_end FROM fixes
           UNION ALL
           SELECT taxi_id, max_by(ts, seq), -1.0::DOUBLE, -1.0::DOUBLE, true FROM fixes
           GROUP BY taxi_id, seq < (SELECT max(event_id) // 16 * 8 FROM events)""",
    )
    # Served rows: the newest of each vehicle.
    for name, value in (("averages", "average_speed"), ("speeds", "speed")):
        sql[f"stream_latest_{name}"] = (
            f"SELECT taxi_id, max(ts) AS ts, max_by(seq, (ts, seq)) AS seq, max_by({value}, (ts, seq)) AS {value}"
            f" FROM ({sql[f'stream_{name}']}) GROUP BY taxi_id"
        )
    sql["stream_latest_ended"] = (
        f"SELECT max_by(ended_trip_count, (ts, seq)) AS ended_trip_count FROM ({sql['stream_ended']}) HAVING count(*) > 0"
    )
    sql["stream_resumed_served"] = sql["stream_latest_averages"]
    # What is read from the topics is what the stream made, once; the fleet's
    # distance is there in the order of arrival.
    for name in ("active", "speeds", "averages", "ended"):
        sql[f"stream_topic_{name}"] = sql[f"stream_{name}"]
    sql["stream_topic_metrics"] = f"SELECT taxi_id, ts, seq FROM ({sql['stream_metrics']})"
    sql["stream_topic_served"] = sql["stream_latest_averages"]
    # Rows come out of a topic as they went in.
    for name in ("active", "speeds", "averages", "metrics", "ended"):
        sql[f"topic_{name}"] = sql[f"stream_{name}"]
    # Slicing long histories changes no row.
    for name in ("clean_fixes", "segment_speed", "avg_speed_running", "fleet_running_distance"):
        sql[f"{name}_sliced"] = sql[name]
    return sql
