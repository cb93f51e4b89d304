"""The live analysis as a stream: messages in, tables out."""

from __future__ import annotations

import time
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wayfleet.config import LIMITS, ZONE, Limits, Zone
from wayfleet.session import ROCKSDB_PROVIDER
from wayfleet.sinks.tables import LiveTables
from wayfleet.sources.messages import rejected_messages, stream_input
from wayfleet.streaming.processor import OUTPUT_SCHEMA, RAW_SCHEMA, VehicleProcessor, bucket_of, milliseconds


#: In an endless stream, how long a vehicle must be silent before what it left
#: behind is handled, and before its state is dropped.
SILENCE, FORGET_AFTER = "10 seconds", "30 days"
#: Keys of the state, each of them vehicles; several for each state partition.
BUCKETS = 512


def live_rows(
    fixes: DataFrame,
    zone: Zone = ZONE,
    limits: Limits = LIMITS,
    trip_end: str = "intent",
    silence: str | None = None,
    forget_after: str | None = None,
    initial: DataFrame | None = None,
    buckets: int = BUCKETS,
) -> DataFrame:
    """One output row per fix, once its vehicle is ``lateness`` ahead of it, has
    come to its end of input, or has been silent for ``silence`` of processing
    time.  Fixes are shuffled once, by buckets of vehicles.  There is no watermark: it would
    cover all vehicles, run ahead of slow partitions and drop their rows.

    ``initial``: where each vehicle stands when the stream begins
    (``start.starting_state``); it is used by the first start of a checkpoint.
    ``buckets``: how many state values the vehicles share; it is settled by the
    first start of a checkpoint."""
    timed = silence is not None or forget_after is not None
    whole = fixes.withColumn("us", F.coalesce(F.unix_micros("ts"), F.lit(0).cast("long"))).drop("ts")
    bucket = bucket_of(F.col("taxi_id"), buckets).alias("bucket")
    if initial is not None:
        initial = initial.filter("taxi_id IS NOT NULL").select(bucket, "*").groupBy("bucket")
    rows = whole.select(bucket, "*").groupBy("bucket").transformWithStateInPandas(
        statefulProcessor=VehicleProcessor(zone, limits, trip_end, silence, forget_after=forget_after),
        outputStructType=RAW_SCHEMA,
        outputMode="append",
        timeMode="ProcessingTime" if timed else "None",
        initialState=initial,
    )
    names = OUTPUT_SCHEMA.fieldNames()
    return rows.withColumn("ts", F.timestamp_micros("us")).select(*names)


def start_live_job(
    messages: DataFrame,
    tables: LiveTables,
    checkpoint: str,
    available_now: bool = False,
    every: str = "1 second",
    partitions: int | None = None,
    **options,
) -> StreamingQuery:
    """Decode, analyse and write the five output tables and the served ones.

    An endless job has timers (``silence``, ``forget_after``; see
    ``live_rows``), unless told otherwise.  One that ends with its input
    (``available_now``) has none: it would wait for them for ever, and messages
    of ``end_of_input`` do their work.

    ``partitions`` is the number of state partitions, fixed by the first start;
    without it the session's shuffle partitions count.  One or two per core are
    enough, as each costs a commit per batch.

    ``checkpoint`` and the tables must lie in storage all executors share.  A
    batch that is run again after a failure replaces what it wrote before.
    """
    timers = {} if available_now else {"silence": SILENCE, "forget_after": FORGET_AFTER}
    rows = live_rows(stream_input(messages), **(timers | options))
    writer = (
        rows.writeStream.foreachBatch(tables.write)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
    )
    with stream_settings(messages.sparkSession, partitions):
        return start(writer, available_now, every)


@contextmanager
def stream_settings(spark: SparkSession, partitions: int | None = None) -> Iterator[None]:
    """Settings of a stateful stream, which copies them from the session when it
    starts; the session has its own again afterwards."""
    wanted = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER}
    if partitions is not None:
        wanted["spark.sql.shuffle.partitions"] = str(partitions)
    before = {name: spark.conf.get(name, None) for name in wanted}
    try:
        for name, value in wanted.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def wait_until_silent(job: StreamingQuery, silence: str = SILENCE, at_most: float = 300.0) -> None:
    """Wait until an endless job has read every message there is and its timers
    have released all that vehicles left behind."""
    # ``processAllAvailable`` never returns here: with timers there is always a next batch.
    wait = timedelta(milliseconds=milliseconds(silence))
    heard = datetime.now(timezone.utc)
    end = time.monotonic() + at_most
    while time.monotonic() < end:
        if not job.isActive:
            raise RuntimeError(f"the job ended: {job.exception()}")
        done = job.lastProgress
        if done is not None:
            began = datetime.fromisoformat(done.timestamp)
            changed = sum(x.numRowsUpdated for x in done.stateOperators)
            if done.numInputRows or changed:
                heard = max(heard, began)
            elif began > heard + wait:
                return
        time.sleep(0.1)
    raise TimeoutError(f"still busy after {at_most} s")


def start_quarantine(
    messages: DataFrame,
    folder: str,
    checkpoint: str,
    available_now: bool = False,
    every: str = "1 minute",
) -> StreamingQuery:
    """Keep messages that are no usable fix, which the live job leaves out."""
    writer = (
        rejected_messages(messages)
        .writeStream.format("parquet")
        .option("path", folder)
        .option("checkpointLocation", checkpoint)
    )
    return start(writer, available_now, every)


def start(writer, available_now: bool, every: str) -> StreamingQuery:
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=every).start()
