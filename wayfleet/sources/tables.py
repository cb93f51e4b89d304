"""Parsed fixes kept as a Parquet table, and other table files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FIX_SCHEMA = T.StructType(
    [
        T.StructField("taxi_id", T.IntegerType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("seq", T.LongType()),
        T.StructField("is_trip_end", T.BooleanType()),
    ]
)


def write_fixes(fixes: DataFrame, path: str) -> None:
    """Write fixes by day, each file sorted by time, so that a time slice reads
    few files and few row groups.

    Rows are spread by ranges of their full order, not by day, so a day that
    holds most rows is written by many tasks.
    """
    (
        fixes.select(*FIX_SCHEMA.fieldNames(), F.to_date("ts").alias("day"))
        .repartitionByRange("day", "ts", "is_trip_end", "seq")
        .sortWithinPartitions("day", "ts", "is_trip_end", "seq")
        .write.mode("overwrite")
        .partitionBy("day")
        .parquet(path)
    )


def read_fixes(spark: SparkSession, path: str) -> DataFrame:
    stored = T.StructType([*FIX_SCHEMA.fields, T.StructField("day", T.DateType())])
    return spark.read.schema(stored).parquet(path)


def read_or_build(
    spark: SparkSession, path: str, build: Callable[[], DataFrame]
) -> DataFrame:
    """The stored table, built and stored first where there is nothing yet.

    A table is complete once its ``_SUCCESS`` file is there; anything else at
    the path is left alone and reported."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(at):
        write_fixes(build(), path)
    elif not files.exists(jvm.org.apache.hadoop.fs.Path(at, "_SUCCESS")):
        raise FileExistsError(f"{path} holds something that is no complete table")
    return read_fixes(spark, path)


def write_csv(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("header", True).csv(path)
