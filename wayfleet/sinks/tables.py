"""Output tables of the live job: five histories and the served documents."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfleet.config import ACTIVE, AVERAGES, ENDED, METRICS, SIZING, SPEEDS, Sizing
from wayfleet.operators.motion import fleet_running_distance, fleet_total
from wayfleet.operators.track import Track
from wayfleet.plans.live import FLEET_ORDER, LiveAnalysis
from wayfleet.sinks.layers import NOTHING, Commit
from wayfleet.sinks.served import AT, ServedTables, Table, served_name
from wayfleet.sources.messages import NUMBERED_SCHEMA, numbered, tag_topics
from wayfleet.streaming.processor import OUTPUT_SCHEMA

REJECTS, LATE, OUTBOX = "rejects", "late", "outbox"
_PLACE = ["longitude", "latitude"]
_BEGIN = -1  # number of the state before the first batch
_ACTIVE_ROW = [*AT, *_PLACE, "distance_to_forbidden_city", "is_violated"]
_SPEED_ROW = [*AT, *_PLACE, "speed", "is_speeding"]
_TYPES = {f.name: f.dataType for f in OUTPUT_SCHEMA} | {
    "total_distance": T.DoubleType(),
    "is_trip_end": T.BooleanType(),
}


def _table(columns: list[str], *kept) -> Table:
    return Table(T.StructType([T.StructField(c, _TYPES[c]) for c in columns]), *kept)


#: The topics' own rows, and the newest of them.
TOPIC_TABLES = {
    ACTIVE: _table(_ACTIVE_ROW),
    SPEEDS: _table(_SPEED_ROW),
    AVERAGES: _table([*AT, "average_speed"]),
    ENDED: _table([*AT, "ended_trip_count"]),
    METRICS: _table([*AT, "total_distance"]),
    served_name(ACTIVE): _table([*_ACTIVE_ROW, "is_trip_end"], ["taxi_id"], ("ts", "is_trip_end", "seq")),
    served_name(SPEEDS): _table(_SPEED_ROW, ["taxi_id"]),
    served_name(AVERAGES): _table([*AT, "average_speed"], ["taxi_id"]),
    served_name(ENDED): _table([*AT, "ended_trip_count"], []),
}


class LiveTables(ServedTables):
    """What the live job writes (``ServedTables``).

    ``publish`` gets the rows of the five topics as messages (``topic, key, value,
    batch, nth``).  A batch stores its messages in an outbox, under its own commit;
    they are published when the next batch begins, as only then the batch is sure
    not to run again with other rows.  ``settle`` publishes what is left when the
    job has ended.  A send that breaks off is repeated, with the same numbers, by
    which readers drop what they have (``streaming.router.once``).
    """

    kinds = TOPIC_TABLES | {
        METRICS: _table([*AT, "segment_km", "total_distance"]),
        REJECTS: _table([*AT, *_PLACE, "reject_reason"]),
        LATE: _table([*AT, *_PLACE, "is_trip_end"]),
        OUTBOX: Table(NUMBERED_SCHEMA),
    }

    def __init__(
        self,
        folder: str,
        sizing: Sizing = SIZING,
        kept_versions: int = 3,
        publish: Callable[[DataFrame], None] | None = None,
        fan: int = 8,
        closed_rows: int = 64_000_000,
    ):
        super().__init__(folder, kept_versions, fan, closed_rows)
        self.sizing, self.publish = sizing, publish

    # -- writing ----------------------------------------------------------

    def begin(self, past: LiveAnalysis) -> None:
        """Served documents and the fleet's distance as ``past`` leaves them, as
        what the first batch of a live job builds on."""
        spark = past.fixes.sparkSession
        past = past.staged(f"{self.folder}/past")
        active, ended = past.active().select(*_ACTIVE_ROW), past.ended().select(*AT, "ended_trip_count")
        rows = {
            served_name(ACTIVE): self._moves(active, ended),
            served_name(SPEEDS): past.speeds(),
            served_name(AVERAGES): past.averages(),
            served_name(ENDED): ended,
        }
        total = fleet_total(past.segments()).first()[0]
        self._commit(spark, rows, {}, _BEGIN, NOTHING, total, total)

    def write(self, batch: DataFrame, batch_id: int) -> None:
        """Sink of one micro-batch (``foreachBatch``)."""
        self._drop_shuffles(batch.sparkSession)
        batch = batch.persist()
        inside, ended = F.col("is_violated").isNotNull(), F.col("ended_trip_count").isNotNull()
        moved, rejected = inside & F.col("segment_km").isNotNull(), F.col("reject_reason").isNotNull()
        try:
            # One job over all tasks of the stateful operator; the writes below
            # read the stored rows.
            found = batch.agg(
                F.count(F.lit(1)).alias("all"),
                F.count_if(inside).alias(ACTIVE),
                F.count_if(moved).alias(SPEEDS),
                F.count_if(ended).alias(ENDED),
                F.count_if(rejected).alias(REJECTS),
                F.count_if("is_late").alias(LATE),
                F.coalesce(F.sum(F.when(moved, F.col("segment_km"))), F.lit(0.0)).alias("km"),
            ).first()
            spark = batch.sparkSession
            if found["all"] == 0 and self.publish is None:
                return
            before = self.log.before(spark, batch_id)
            waiting, before = before, self._published(spark, before)
            if found["all"] == 0:
                if before is not waiting:
                    self._commit(spark, {}, {}, batch_id, before, before.total, before.past)
                return
            running = self._fleet(batch.filter(moved).select(*AT, "segment_km"), before.total)
            rows = {
                ACTIVE: batch.filter(inside),
                SPEEDS: batch.filter(moved),
                AVERAGES: batch.filter(inside),
                ENDED: batch.filter(ended),
                METRICS: running,
                REJECTS: batch.filter(rejected),
                LATE: batch.filter("is_late"),
            }
            sizes = found.asDict() | {AVERAGES: found[ACTIVE], METRICS: found[SPEEDS]}
            rows = {table: x.select(*self.kinds[table].schema.names) for table, x in rows.items()}
            if self.publish is not None:
                sent = {topic: rows[topic] for topic in (ACTIVE, ENDED, SPEEDS, AVERAGES)}
                tagged = tag_topics(sent | {METRICS: running.drop("segment_km")})
                rows[OUTBOX] = numbered(tagged, batch_id)
                sizes[OUTBOX] = sum(sizes[topic] for topic in (*sent, METRICS))
            self._with_served(rows, sizes)
            # A table that gets no row keeps its layers.
            new = {table: x for table, x in rows.items() if sizes[table]}
            total = before.total + found["km"]
            self._commit(spark, new, sizes, batch_id, before, total, before.past)
        finally:
            batch.unpersist()

    def _published(self, spark: SparkSession, before: Commit) -> Commit:
        """The same state with its outbox sent and empty."""
        waiting = before.layers(OUTBOX)
        if self.publish is None or not waiting:
            return before
        self.publish(self._rows(spark, OUTBOX, waiting))
        return replace(before, tables={t: x for t, x in before.tables.items() if t != OUTBOX})

    def settle(self, spark: SparkSession) -> None:
        """Publish the messages of the last batch, after the job has ended."""
        waiting = self.log.newest(spark)
        sent = self._published(spark, waiting)
        if sent is not waiting:
            self._commit(spark, {}, {}, sent.batch, sent, sent.total, sent.past)

    def _fleet(self, segments: DataFrame, before: float) -> DataFrame:
        """Fleet distance after each segment in the order of arrival: the sum of
        earlier batches, then a running sum within this one."""
        fleet = Track.of(segments, (), FLEET_ORDER, self.sizing)
        running = fleet.unmark(fleet_running_distance(segments, fleet))
        return running.select(
            *AT, "segment_km", (F.col("total_distance") + before).alias("total_distance")
        )

    # -- reading ----------------------------------------------------------

    def fleet_distance(self, spark: SparkSession) -> DataFrame:
        """Fleet distance after each segment in the order of time, whatever the
        order of arrival was."""
        now = self.log.newest(spark)
        segments = self._rows(spark, METRICS, now.layers(METRICS)).select(*AT, "segment_km")
        fleet = Track.of(segments, (), FLEET_ORDER, self.sizing)
        rows = fleet.unmark(fleet_running_distance(segments, fleet))
        return rows.select(*AT, (F.col("total_distance") + now.past).alias("total_distance"))
