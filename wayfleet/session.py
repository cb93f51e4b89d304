"""Spark settings this library is written for."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)


def settings() -> dict[str, str]:
    return {
        # Log timestamps carry no zone; one fixed zone makes differences exact.
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.parquet.filterPushdown": "true",
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    }


def local_session(app: str, cores: str = "8", partitions: int = 8) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(partitions))
    )
    for key, value in settings().items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_fallback: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: the one the cluster names.  Where none
    is named, a session on one machine gets a temporary one; on a cluster that
    would lie on each executor's own disk, so it is an error."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError(
            "set spark.checkpoint.dir to a folder that the driver and all executors share"
        )
    if not _fallback:
        _fallback.append(tempfile.mkdtemp(prefix="wayfleet-"))
    return _fallback[0]
