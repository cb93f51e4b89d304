"""Helpers shared by the operators: stored intermediate tables, numbering of
rows without one task per group, and connected components."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from wayfleet.session import shared_folder

#: Separators of words in every contract of this package: [\x20\x09-\x0D].
#: bytes.split() without arguments splits at exactly these.
WORD = r"[^\x20\x09-\x0D]+"


def stored(frame: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``frame`` to the shared folder and read it back: lineage ends
    there, and lost executors cost nothing that was finished.

    Spark deletes the shuffle files of finished work when the driver collects
    garbage, which a driver with little to do hardly does; so it is asked to,
    before more are written."""
    spark = frame.sparkSession
    path = f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in frame.schema])
    spark._jvm.System.gc()
    frame.write.parquet(path)
    spark._jvm.System.gc()
    return spark.read.schema(schema).parquet(path), path


def unused(frame: DataFrame, name: str) -> str:
    """``name``, made longer until no column of ``frame`` has it."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


#: Keys up to this number are broadcast; more are joined by shuffling.
BROADCAST_KEYS = 1_000_000


def broadcast_if_few(keys: DataFrame) -> DataFrame:
    """``keys``, a stored table of narrow rows, marked for broadcast if counting
    shows that there are at most ``BROADCAST_KEYS``: rows with whole texts then
    stay where they are."""
    return F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys


def forget(spark: SparkSession, *paths: str) -> None:
    """Delete stored tables that nothing reads any more."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    for path in paths:
        at = hadoop.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def text_bytes(column: str = "text") -> Column:
    """UTF-8 bytes of a text; null counts as empty."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def with_row_number(frame: DataFrame, name: str, keys: list[str], bucket: Column, order: list[Column]) -> DataFrame:
    """``name``: gapless number from 0 within ``keys``, in the order of
    (``bucket``, ``order``).  Rows are numbered within (keys, bucket), and one
    count per (keys, bucket) supplies what comes before, so that a key with a
    third of all rows is spread over its buckets.  Keys must be few and not
    null: the counts are broadcast, one for each key and bucket."""
    part, before = "__bucket", "__before"
    frame = frame.withColumn(part, bucket)
    ahead = Window.partitionBy(*keys).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    counts = frame.groupBy(*keys, part).agg(F.count(F.lit(1)).alias(before))
    counts = counts.withColumn(before, F.coalesce(F.sum(before).over(ahead), F.lit(0)))
    own = Window.partitionBy(*keys, part).orderBy(*order)
    numbered = frame.withColumn(name, F.row_number().over(own) - 1)
    return numbered.join(F.broadcast(counts), [*keys, part]).withColumn(
        name, (F.col(name) + F.col(before)).cast("long")
    ).drop(part, before)


def join_skewed(rows: DataFrame, side: DataFrame, key: str, hot: int = 1000) -> DataFrame:
    """Inner join of ``rows`` with ``side``, which has one row for each value of
    ``key``.  Values that more than one in ``hot`` rows have are at most ``hot``;
    their rows of ``side`` are broadcast, so their many rows stay where they are."""
    counted = rows.groupBy(key).agg(F.count(F.lit(1)).alias("__count"))
    total = rows.agg(F.count(F.lit(1)).alias("__total")).first()[0]
    often = counted.where(F.col("__count") * hot > total).select(key)
    few = F.broadcast(side.join(F.broadcast(often), key, "left_semi"))
    rest = rows.join(F.broadcast(often), key, "left_anti").join(side, key)
    return rows.join(few, key).unionByName(rest)


def with_rank(frame: DataFrame, name: str, order: list[Column]) -> DataFrame:
    """``name``: gapless number from 1 over all rows in ``order``; rows are dealt
    by range and one count for each range supplies what comes before."""
    spark, part, own, before = frame.sparkSession, "__range", "__own", "__before"
    spread = frame.repartitionByRange(shuffle_partitions(spark), *order).sortWithinPartitions(*order)
    placed, _ = stored(spread.withColumn(own, F.monotonically_increasing_id()), "ranked")
    placed = placed.withColumn(part, F.shiftright(own, 33)).withColumn(own, F.col(own).bitwiseAND((1 << 33) - 1))
    ahead = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy(part).agg(F.count(F.lit(1)).alias(before))
    counts = counts.withColumn(before, F.coalesce(F.sum(before).over(ahead), F.lit(0)))
    ranked = placed.join(F.broadcast(counts), part)
    return ranked.withColumn(name, (F.col(own) + F.col(before) + 1).cast("long")).drop(part, own, before)


def _signature(edges: DataFrame) -> tuple:
    mix = F.xxhash64("a", "b")
    row = edges.agg(F.count(F.lit(1)), F.bit_xor(mix), F.sum(mix.bitwiseAND(F.lit((1 << 30) - 1)))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a long, b long): root is the
    smallest node connected with it.

    Large-star and small-star steps by turns until nothing changes; each
    round is two aggregations by node and joins, its result a stored table.
    Edges, nodes and roots stay distributed.
    """
    spark = edges.sparkSession
    edges, path = stored(edges.where("a <> b").selectExpr("greatest(a, b) AS a", "least(a, b) AS b").distinct(), "edges")
    before = _signature(edges)
    while before[0]:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").where("b > a AND b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").selectExpr("inline(array(struct(a, m AS b), struct(b AS a, m AS b)))")
        after, new = stored(small.where("a <> b").distinct(), "edges")
        forget(spark, path)
        edges, path, now = after, new, _signature(after)
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        edges.select("b", "b")
    ).distinct()


def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches that have rows."""
    return (batch for batch in source if batch.num_rows)
