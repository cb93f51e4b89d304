"""The output topics as a stream: each message once, rows by topic, served documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from wayfleet.config import METRICS, OUTPUT_TOPICS
from wayfleet.sinks.served import AT, ServedTables, Table
from wayfleet.sinks.tables import TOPIC_TABLES
from wayfleet.sources.messages import NUMBERED_SCHEMA
from wayfleet.streaming.job import start, stream_settings

UNROUTED = "unrouted"
MARKS = "marks"
_NONE = -1  # stands for a number that a message does not have
_NUMBER = ("batch", "nth")
_TASKS_A_CORE = 2
#: Columns of the topics' rows, each with the topics that have it.
_COLUMNS: dict[tuple[str, T.DataType], list[str]] = {}
for _topic in OUTPUT_TOPICS:
    for _column in TOPIC_TABLES[_topic].schema:
        _COLUMNS.setdefault((_column.name, _column.dataType), []).append(_topic)


def once(messages: DataFrame, marks: DataFrame | None) -> DataFrame:
    """Numbered messages that have not been seen: each number of a topic's key
    once, and above its mark; messages that have no number pass as they are.

    Under a key numbers rise, but for a send that broke off and begins again
    from where its batch began.  So whatever is not above the highest number
    seen (``marks``: a row per topic and key) has been seen itself, and one
    number per key is all that is kept, however long the stream.  Without
    marks nothing has been seen."""
    numbers = {c: F.coalesce(c, F.lit(_NONE).cast("long")) for c in _NUMBER}
    free = (F.col("batch") == _NONE) | (F.col("nth") == _NONE)
    # A message without a number is like no other.
    apart = messages.withColumns(numbers).withColumn("_free", F.when(free, F.monotonically_increasing_id()))
    # Sorted by the number first: names of topics begin alike, numbers differ.
    same = Window.partitionBy("nth", "batch", "key", "topic", "_free").orderBy(F.lit(0))
    # Not by row number: Spark would sort the messages before the shuffle as well,
    # where copies hardly ever meet.
    first = apart.withColumn("_copy", F.lag(F.lit(1)).over(same)).filter("_copy IS NULL")
    if marks is None:
        return first.select(*NUMBERED_SCHEMA.names)
    seen = marks.select(F.col("topic").alias("_topic"), F.col("key").alias("_key"), F.struct(*_NUMBER).alias("_mark"))
    at = F.col("topic").eqNullSafe(F.col("_topic")) & F.col("key").eqNullSafe(F.col("_key"))
    above = F.col("_mark").isNull() | (F.struct(*_NUMBER) > F.col("_mark"))
    return first.join(seen, at, "left").filter(F.col("_free").isNotNull() | above).select(*NUMBERED_SCHEMA.names)


def _field(name: str, kind: T.DataType) -> Column:
    return F.try_variant_get("body", f"$.{name}", kind.simpleString())


def routed(messages: DataFrame) -> DataFrame:
    """Messages with the columns of all topics' rows, those of other topics
    NULL, and whether they are rows of one of the topics.  Each value is parsed
    once and each field taken from it once; only messages that are no rows keep
    their value."""
    read = messages.withColumn("body", F.try_parse_json("value"))
    columns = [F.when(F.col("topic").isin(*topics), _field(name, kind)).alias(name) for (name, kind), topics in _COLUMNS.items()]
    read = read.select("topic", "key", "value", *_NUMBER, *columns)
    complete = F.lit(True)
    for name in AT:
        complete = complete & F.col(name).isNotNull()
    return read.withColumn("is_routed", complete).withColumn("value", F.when(~F.col("is_routed"), F.col("value")))


def rows_of(routed_messages: DataFrame, topic: str) -> DataFrame:
    """Rows of a topic, by the columns of its table."""
    mine = F.col("is_routed") & (F.col("topic") == topic)
    return routed_messages.filter(mine).select(*TOPIC_TABLES[topic].schema.names)


def marks_of(numbered: DataFrame) -> DataFrame:
    """The highest number of each topic's key in each of the numbers' batches:
    plain numbers, which are summed up without sorting the messages."""
    return numbered.groupBy("topic", "key", "batch").agg(F.max("nth").alias("nth"))


class TopicTables(ServedTables):
    """Rows of the five topics, what is served of them, and the messages that
    belong to none (``unrouted``: another topic, no JSON object, no vehicle,
    time or number).  The highest number seen under each topic's key (``marks``)
    is a table like the others, under the same commit: a batch that runs again
    begins from the marks it began from before."""

    kinds = TOPIC_TABLES | {
        UNROUTED: Table(T.StructType(NUMBERED_SCHEMA.fields[:3])),
        MARKS: Table(T.StructType([f for f in NUMBERED_SCHEMA if f.name != "value"]), ["topic", "key"], _NUMBER),
    }

    def write(self, batch: DataFrame, batch_id: int) -> None:
        """Sink of one micro-batch: it is read and parsed once, all topics
        are taken from the stored rows."""
        spark = batch.sparkSession
        self._drop_shuffles(spark)
        before = self.log.before(spark, batch_id)
        marks = self._newest(spark, MARKS, before) if before.layers(MARKS) else None
        stored = routed(once(batch, marks)).persist()
        # The plan of a stream keeps all its shuffle partitions; each table would
        # be summed up from as many parts, each in as many pieces.
        batch = stored.coalesce(_TASKS_A_CORE * spark.sparkContext.defaultParallelism)
        marked = F.struct(*_NUMBER) > F.struct(*[F.lit(_NONE).cast("long")] * 2)
        try:
            here = {topic: F.col("is_routed") & (F.col("topic") == topic) for topic in OUTPUT_TOPICS}
            found = batch.agg(
                *[F.count_if(condition).alias(topic) for topic, condition in here.items()],
                F.count_if(~F.col("is_routed")).alias(UNROUTED),
                F.count_if(marked).alias(MARKS),
                F.coalesce(F.max(F.when(here[METRICS], F.col("total_distance"))), F.lit(0.0)).alias("km"),
            ).first()
            sizes = found.asDict()
            if not any(sizes[table] for table in (*OUTPUT_TOPICS, UNROUTED)):
                return
            rows = {topic: rows_of(batch, topic) for topic in OUTPUT_TOPICS}
            rows[UNROUTED] = batch.filter("NOT is_routed").select("topic", "key", "value")
            rows[MARKS] = marks_of(batch.filter(marked))
            self._with_served(rows, sizes)
            new = {table: x for table, x in rows.items() if sizes[table]}
            # The fleet's distance only grows, so the greatest is the newest.
            total = max(before.total, found["km"])
            self._commit(spark, new, sizes, batch_id, before, total, before.past)
        finally:
            stored.unpersist()


def start_router(
    messages: DataFrame,
    tables: TopicTables,
    checkpoint: str,
    available_now: bool = False,
    every: str = "1 second",
    partitions: int | None = None,
) -> StreamingQuery:
    """Read the topics (``messages.kafka_topics``) as one stream and keep their
    tables.  The stream is read once, whatever the number of topics.
    ``partitions``: as the session's shuffle partitions."""
    writer = (
        messages.writeStream.foreachBatch(tables.write)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
    )
    with stream_settings(messages.sparkSession, partitions):
        return start(writer, available_now, every)
