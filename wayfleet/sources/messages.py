"""Keyed JSON messages: encode, decode, and the streaming sources."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfleet.config import INPUT_TOPIC, OUTPUT_TOPICS
from wayfleet.functions.rows import is_finite, trip_end
from wayfleet.functions.time import format_timestamp, parse_timestamp

MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("taxi_id", T.IntegerType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("flush", T.BooleanType()),
    ]
)

# Messages of the output topics: ``batch`` and ``nth`` number them in the order
# they are sent under a key.
NUMBERED_SCHEMA = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("batch", T.LongType()),
        T.StructField("nth", T.LongType()),
    ]
)


def encode(fixes: DataFrame) -> DataFrame:
    """``key`` = vehicle id as text, ``value`` = JSON of the four fields, with
    the sequence number beside them."""
    record = F.struct(
        "taxi_id", format_timestamp(F.col("ts")).alias("timestamp"), "longitude", "latitude"
    )
    return fixes.select(
        F.col("taxi_id").cast("string").alias("key"),
        F.to_json(record).alias("value"),
        "seq",
    )


def encode_rows(topic: str, rows: DataFrame) -> DataFrame:
    """Any output rows as messages of ``topic``."""
    key = F.col("taxi_id").cast("string") if "taxi_id" in rows.columns else F.lit(topic)
    return rows.select(
        F.lit(topic).alias("topic"),
        key.alias("key"),
        F.to_json(F.struct(*rows.columns)).alias("value"),
    )


def _record():
    return F.from_json("value", MESSAGE_SCHEMA)


def _with_record(messages: DataFrame) -> DataFrame:
    """Messages with their records (``_r``), each value parsed once: a filter on
    a plain column would be pushed below it and parse anew for every field."""
    return messages.select("*", F.explode(F.array(_record())).alias("_r"))


def decode(messages: DataFrame) -> DataFrame:
    """Fixes from messages; fields that do not convert are NULL."""
    return _fixes(messages.withColumn("_r", _record()))


def _fixes(read: DataFrame) -> DataFrame:
    return (
        read.select(
            F.col("_r.taxi_id").alias("taxi_id"),
            parse_timestamp(F.col("_r.timestamp")).alias("ts"),
            F.col("_r.longitude").alias("longitude"),
            F.col("_r.latitude").alias("latitude"),
            "seq",
        )
        .withColumn("is_trip_end", F.coalesce(trip_end(), F.lit(False)))
    )


def end_of_input(fixes: DataFrame) -> DataFrame:
    """A message per vehicle that says that no more of its fixes will come: the
    live job then handles those it still holds.  It is no fix itself and is in
    no table.  Send it after the vehicle's fixes, under the same key."""
    record = F.struct("taxi_id", F.lit(True).alias("flush"))
    return fixes.groupBy("taxi_id").agg(F.max("seq").alias("seq")).select(
        F.col("taxi_id").cast("string").alias("key"),
        F.to_json(record).alias("value"),
        (F.col("seq") + 1).alias("seq"),
    )


def _flushes() -> Column:
    return F.coalesce(F.col("_r.flush") & F.col("_r.taxi_id").isNotNull(), F.lit(False))


def unusable() -> Column:
    """Why a record is no fix, or NULL: fixes are complete, at a finite place,
    and at a time of the years 1 to 9999, all of which every later step carries."""
    finite = is_finite(F.col("_r.longitude")) & is_finite(F.col("_r.latitude"))
    complete = F.col("_r").isNotNull() & F.col("_r.taxi_id").isNotNull()
    in_range = F.year(parse_timestamp(F.col("_r.timestamp"))).between(1, 9999)
    return (
        F.when(~complete, F.lit("no_vehicle"))
        .when(~F.coalesce(in_range, F.lit(False)), F.lit("no_time"))
        .when(~F.coalesce(finite, F.lit(False)), F.lit("no_place"))
    )


def _usable() -> Column:
    return unusable().isNull() & ~_flushes()


def stream_input(messages: DataFrame) -> DataFrame:
    """Usable fixes, and ends of input (``is_flush``)."""
    kept = _with_record(messages).filter(_usable() | _flushes())
    return _fixes(kept).withColumn("is_flush", F.col("ts").isNull())


def complete_fixes(messages: DataFrame) -> DataFrame:
    """Decoded messages that are usable fixes."""
    return _fixes(_with_record(messages).filter(_usable()))


def rejected_messages(messages: DataFrame) -> DataFrame:
    """The quarantine: messages that are no usable fix, as they came, with the
    reason."""
    read = _with_record(messages).filter(~_flushes())
    return read.withColumn("reason", unusable()).filter("reason IS NOT NULL").drop("_r")


def tag_topics(outputs: Mapping[str, DataFrame]) -> DataFrame:
    """One stream of messages over several topics, tagged with the topic."""
    tagged = [encode_rows(topic, rows) for topic, rows in outputs.items()]
    return reduce(DataFrame.unionByName, tagged)


def numbered(messages: DataFrame, batch: int) -> DataFrame:
    """Messages with the numbers of a batch.  The numbers are settled when they
    are stored; before that, each evaluation gives others."""
    return messages.withColumn("batch", F.lit(batch).cast("long")).withColumn("nth", F.monotonically_increasing_id())


def in_order(messages: DataFrame) -> DataFrame:
    """Numbered messages, those of one key in one task and by number, as they
    have to be sent."""
    return messages.repartition("topic", "key").sortWithinPartitions("batch", "nth")


def route(messages: DataFrame, topic: str, schema: T.StructType) -> DataFrame:
    """Rows of one topic of a tagged stream."""
    return (
        messages.filter(F.col("topic") == topic)
        .select(F.from_json("value", schema).alias("_r"))
        .select("_r.*")
    )


def kafka_stream(
    spark: SparkSession,
    servers: str,
    topics: Sequence[str] = (INPUT_TOPIC,),
    per_trigger: int = 5_000_000,
) -> DataFrame:
    """Messages of one or more topics, from the earliest offset: ``topic, key,
    value, seq``.  ``seq`` is the offset within the partition; a vehicle's
    messages share a key and therefore a partition."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", "earliest")
        .option("maxOffsetsPerTrigger", per_trigger)
        .load()
        .select(
            "topic",
            F.col("key").cast("string").alias("key"),
            F.col("value").cast("string").alias("value"),
            F.col("offset").alias("seq"),
        )
    )


def send_fixes(fixes: DataFrame, servers: str) -> None:
    """Send fixes to the input topic.  A vehicle's fixes are sent by one task in
    time order; the reader needs no order between vehicles."""
    spread = fixes.repartition("taxi_id")
    sent = encode(spread.sortWithinPartitions("ts", "is_trip_end", "seq"))
    write_kafka(sent.withColumn("topic", F.lit(INPUT_TOPIC)), servers)


def write_kafka(messages: DataFrame, servers: str) -> None:
    """Send ``topic, key, value`` rows of a batch."""
    (
        messages.select("topic", "key", "value")
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .save()
    )


def publish_kafka(messages: DataFrame, servers: str) -> None:
    """Send numbered messages; the numbers travel in the headers."""
    headers = F.array(
        *[
            F.struct(F.lit(name).alias("key"), F.col(name).cast("string").cast("binary").alias("value"))
            for name in ("batch", "nth")
        ]
    )
    (
        in_order(messages)
        .select("topic", "key", "value", headers.alias("headers"))
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("includeHeaders", "true")
        .save()
    )


def kafka_topics(
    spark: SparkSession, servers: str, topics: Sequence[str] = OUTPUT_TOPICS, per_trigger: int = 5_000_000
) -> DataFrame:
    """Numbered messages of the output topics; numbers are NULL where a
    message has none."""
    read = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", "earliest")
        .option("includeHeaders", "true")
        .option("maxOffsetsPerTrigger", per_trigger)
        .load()
    )

    def header(name: str) -> Column:
        found = F.filter("headers", lambda h: h["key"] == name)
        return F.get(found, F.lit(0))["value"].cast("string").try_cast("long").alias(name)

    return read.select(
        "topic",
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        header("batch"),
        header("nth"),
    )


def publish_files(messages: DataFrame, folder: str, compression: str = "none") -> None:
    """Add numbered messages to a folder of JSON files, compressed where wanted,
    as a broker keeps them: their texts are much alike."""
    in_order(messages).write.mode("append").option("compression", compression).json(folder)


def file_topics(
    spark: SparkSession, folder: str, files_per_trigger: int | None = None, bytes_per_trigger: int = 1 << 30
) -> DataFrame:
    """Numbered messages from a folder of JSON files, read in the order of the
    files' times: files of a later send need later ones.  A batch is bounded by
    its bytes, or by its number of files where that is given."""
    most = ("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else ("maxBytesPerTrigger", bytes_per_trigger)
    return spark.readStream.schema(NUMBERED_SCHEMA).option(*most).json(folder)


def file_stream(
    spark: SparkSession, folder: str, files_per_trigger: int = 1000
) -> DataFrame:
    """The same messages from JSON files with ``key, value, seq`` fields."""
    schema = "key string, value string, seq bigint"
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_trigger)
        .json(folder)
    )
