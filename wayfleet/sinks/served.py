"""Histories and served documents that change together, in layers."""

from __future__ import annotations

import gc
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfleet.config import ACTIVE, AVERAGES, ENDED, METRICS, SPEEDS
from wayfleet.operators.serve import document_for, latest_by_key, without_ended
from wayfleet.sinks.layers import NOTHING, Commit, CommitLog, Layer, merged_from

AT = ["taxi_id", "ts", "seq"]


@dataclass(frozen=True)
class Table:
    """``keys``: the newest row per key, by ``order``; None for a history."""

    schema: T.StructType
    keys: list[str] | None = None
    order: tuple[str, ...] = ("ts", "seq")


def served_name(topic: str) -> str:
    return f"served/{topic}"


class ServedTables:
    """Tables under one folder of shared storage, written by one job at a time.

    All tables (``kinds``) are made of layers and change together, by one commit
    per batch (``layers``): readers see whole batches, and a repeated batch replaces
    what it wrote before.  A batch writes its own rows; older layers are merged
    with them as they grow (served tables to the newest row per key), and the
    layers of a served table are merged again when it is read.  Layers of a
    history that have ``closed_rows`` are final.  Layers and commits out of use
    stay for ``kept_versions`` commits, for readers that began before.
    """

    kinds: dict[str, Table]

    def __init__(self, folder: str, kept_versions: int = 3, fan: int = 8, closed_rows: int = 64_000_000):
        if kept_versions < 1 or fan < 2:
            raise ValueError("at least one version and two layers are needed")
        self.folder = folder.rstrip("/")
        self.kept_versions = kept_versions
        self.fan, self.closed_rows = fan, closed_rows
        self.log = CommitLog(self.folder)
        self._swept = False

    # -- writing ----------------------------------------------------------

    @staticmethod
    def _drop_shuffles(spark: SparkSession) -> None:
        """Let go of the shuffle files of earlier batches, which else stay on the
        executors' disks until the driver happens to collect its garbage."""
        gc.collect()
        spark.sparkContext._jvm.System.gc()

    @staticmethod
    def _moves(active: DataFrame, ended: DataFrame) -> DataFrame:
        """Active documents and the markers that delete them."""
        return active.withColumn("is_trip_end", F.lit(False)).unionByName(
            ended.select(*AT, F.lit(True).alias("is_trip_end")), allowMissingColumns=True
        )

    def _with_served(self, rows: dict[str, DataFrame], sizes: dict[str, int]) -> None:
        """Add the rows that a batch brings to the served tables."""
        sizes[served_name(ACTIVE)] = sizes[ACTIVE] + sizes[ENDED]
        rows[served_name(ACTIVE)] = self._moves(rows[ACTIVE], rows[ENDED])
        for topic in (SPEEDS, AVERAGES, ENDED):
            rows[served_name(topic)], sizes[served_name(topic)] = rows[topic], sizes[topic]

    def _commit(
        self,
        spark: SparkSession,
        rows: dict[str, DataFrame],
        sizes: dict[str, int],
        batch_id: int,
        before: Commit,
        total: float,
        past: float,
    ) -> None:
        """Write a layer for every table of ``rows``, then make them count."""
        if not self._swept:
            self.log.sweep(spark, list(self.kinds))
            self._swept = True
        name = f"{batch_id}-{uuid.uuid4().hex}"
        tables = dict(before.tables)
        # The tables are independent and small, so their jobs overlap.
        with ThreadPoolExecutor(max_workers=max(1, len(rows))) as pool:
            jobs = {
                table: pool.submit(self._layered, table, new, sizes.get(table), before.layers(table), name)
                for table, new in rows.items()
            }
            tables |= {table: job.result() for table, job in jobs.items()}
        self.log.add(spark, batch_id, total, past, tables)
        self.log.forget(spark, self.kept_versions)

    def _layered(
        self, table: str, rows: DataFrame, size: int | None, layers: tuple[Layer, ...], name: str
    ) -> tuple[Layer, ...]:
        """Layers with one more of ``rows``, which takes older ones in when
        there are enough of them.  Served rows are counted after the write."""
        kind, spark = self.kinds[table], rows.sparkSession
        rows = rows.select([F.col(f.name).cast(f.dataType) for f in kind.schema])
        first = len(layers)
        closed = self.closed_rows if kind.keys is None else None
        if layers:
            first = merged_from([*(x.rows for x in layers), size], self.fan, closed)
            if first < len(layers):
                rows = rows.unionByName(self._rows(spark, table, layers[first:]))
        if kind.keys is not None:
            rows = latest_by_key(rows, kind.keys, kind.order)
        path = f"{table}/{name}"
        rows.write.parquet(f"{self.folder}/{path}")
        if kind.keys is None:
            written = size + sum(x.rows for x in layers[first:])
        else:
            written = spark.read.schema(kind.schema).parquet(f"{self.folder}/{path}").count()
        return (*layers[:first], Layer(path, written))

    # -- reading ----------------------------------------------------------

    def _rows(self, spark: SparkSession, table: str, layers: tuple[Layer, ...]) -> DataFrame:
        schema = self.kinds[table].schema
        if not layers:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(*(f"{self.folder}/{x.path}" for x in layers))

    def history(self, spark: SparkSession, table: str) -> DataFrame:
        return self._rows(spark, table, self.log.newest(spark).layers(table))

    def latest(self, spark: SparkSession, table: str) -> DataFrame:
        """Newest row per key, without vehicles whose trip has ended; no row
        before the first batch."""
        return self._latest(spark, table, self.log.newest(spark))

    def _latest(self, spark: SparkSession, table: str, now: Commit) -> DataFrame:
        rows = self._newest(spark, served_name(table), now)
        if "is_trip_end" in rows.columns:
            rows = without_ended(rows).drop("is_trip_end")
        return rows

    def _newest(self, spark: SparkSession, table: str, now: Commit) -> DataFrame:
        """Newest row per key of a table with keys, merged from its layers."""
        kind, layers = self.kinds[table], now.layers(table)
        rows = self._rows(spark, table, layers)
        return latest_by_key(rows, kind.keys, kind.order) if len(layers) > 1 else rows

    def served(self, spark: SparkSession, table: str) -> DataFrame:
        """Documents as they are served."""
        now = self.log.newest(spark)
        if table == METRICS:
            total = [] if now is NOTHING else [(now.total,)]
            return document_for(METRICS, spark.createDataFrame(total, "total_distance double"))
        rows = self._latest(spark, table, now)
        if table == ENDED:
            # Seeded: 0 until a first trip has ended.
            count = F.coalesce(F.max("ended_trip_count"), F.lit(0).cast("long"))
            return rows.agg(count.alias("ended_trip_count"))
        return document_for(table, rows)
