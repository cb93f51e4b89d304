"""Balanced label propagation: linked documents move to their neighbours' shards.

Links are groups (equal texts, in the query): every two members of a group are
linked.  Groups too large for half a shard are cut into cells of that size, so
each cell can lie together.  Documents begin in shards by hash.  In each round a
member wants the shard that holds most of its cell.  The wishes are counted by
(from, to), at most shards x shards numbers, and quotas decide how many of each
may move: exchanges between two shards first, then what room there is.  A
shard's room is its share of all documents less the linked ones that it holds,
since the others can make way.  Those that gain most neighbours move first.  At
the end shards are evened out to counts that differ by one at most; documents
without links go first, so that cells stay together.

Law: ``rows``.  Null texts have no bytes and are equal to empty ones.  Rows
repeated with one doc_id are separate documents; null ids are documents too.
Ties are decided by hashes and row numbers.  With no rows the result is empty.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wayfleet.llm.work import forget, shuffle_partitions, stored, with_row_number

ROUNDS = 4
ROW_OVERHEAD = 16


def _linked(nodes: DataFrame, cell_rows: int) -> DataFrame:
    """(row, cell, shard) of documents that share a group with another."""
    sizes = nodes.groupBy("group").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    members = nodes.join(sizes, "group").select("row", "group", "shard", "members")
    small = members.where(F.col("members") <= cell_rows).select("row", F.col("group").alias("cell"), "shard")
    spread = F.pmod(F.xxhash64("row"), F.lit(shuffle_partitions(nodes.sparkSession)))
    large = with_row_number(
        members.where(F.col("members") > cell_rows), "number", ["group"], spread, [F.col("row")]
    )
    cell = F.xxhash64("group", F.floor(F.col("number") / cell_rows))
    return small.unionByName(large.select("row", cell.alias("cell"), "shard"))


def quotas(wishes: np.ndarray, sizes: np.ndarray, most: int) -> np.ndarray:
    """How many may move from shard i to shard j, given how many want to."""
    allowed = np.minimum(wishes, wishes.T)
    rest = wishes - allowed
    room = np.maximum(0, most - sizes)
    for to in np.argsort(sizes, kind="stable"):
        for source in np.argsort(-rest[:, to] * (sizes > 0), kind="stable"):
            take = min(rest[source, to], room[to])
            if take <= 0:
                break
            allowed[source, to] += take
            room[to] -= take
    return allowed


def _round(linked: DataFrame, sizes: np.ndarray, most: int, shards: int) -> DataFrame | None:
    """The linked documents after one round; None if no one moves."""
    held = linked.groupBy("cell", "shard").agg(F.count(F.lit(1)).alias("n"))
    own = Window.partitionBy("cell")
    rank = F.struct("n", F.xxhash64("cell", "shard"), "shard")
    held = held.withColumn("best", F.max(rank).over(own)).select(
        "cell", "shard", F.col("best.shard").alias("to"), (F.col("best.n") - F.col("n")).alias("gain")
    )
    wishes, path = stored(linked.join(held, ["cell", "shard"]), "wishes")
    matrix = np.zeros((shards, shards), dtype=np.int64)
    for row in wishes.where("shard <> to").groupBy("shard", "to").count().collect():
        matrix[row["shard"], row["to"]] = row["count"]
    allowed = quotas(matrix, sizes, most)
    if not allowed.any():
        forget(linked.sparkSession, path)
        return None
    flat = [(int(i), int(j), int(allowed[i, j])) for i, j in np.argwhere(allowed)]
    quota = linked.sparkSession.createDataFrame(flat, "shard int, to int, quota long")
    # Larger gains first; members of a cell one after another.
    bucket = (63 - F.floor(F.log2(F.col("gain") + 1))) * 64 + F.pmod(F.xxhash64("cell"), F.lit(64))
    movers = with_row_number(
        wishes.where("shard <> to").join(F.broadcast(quota), ["shard", "to"]),
        "number", ["shard", "to"], bucket, [F.col("cell"), F.col("row")],
    )
    moved = movers.where("number < quota").select("row", F.col("to").alias("new"))
    after = wishes.join(moved, "row", "left").select("row", "cell", F.coalesce("new", "shard").alias("shard"))
    after, _ = stored(after, "linked")
    forget(linked.sparkSession, path)
    return after


def _pick(values: np.ndarray, at: Column) -> Column:
    return F.get(F.array(*[F.lit(int(v)) for v in values]), at.cast("int"))


def assigned(nodes: DataFrame, shards: int, rounds: int = ROUNDS) -> DataFrame:
    """``shard`` and ``slot`` for every row of ``nodes`` (row: unique long,
    group: long, further columns kept)."""
    start = F.pmod(F.xxhash64("row", F.lit(11)), F.lit(shards)).cast("int")
    nodes, _ = stored(nodes.withColumn("shard", start), "nodes")

    def count(rows: DataFrame) -> np.ndarray:
        out = np.zeros(shards, dtype=np.int64)
        for row in rows.groupBy("shard").count().collect():
            out[row["shard"]] = row["count"]
        return out

    sizes = count(nodes)
    total = int(sizes.sum())
    most = -(-total // shards)
    linked, _ = stored(_linked(nodes, max(1, total // shards // 2)), "linked")
    for _ in range(rounds):
        after = _round(linked, count(linked), most, shards)
        if after is None:
            break
        linked = after
    placed = nodes.join(linked.select("row", F.col("shard").alias("new"), F.lit(1).alias("is_linked")), "row", "left")
    placed = placed.withColumn("shard", F.coalesce("new", "shard")).withColumn("spare", F.col("is_linked").isNull())
    nodes, _ = stored(placed.drop("new", "is_linked"), "placed")

    # Even out: the last rows of too full shards fill the others' last slots.
    sizes = count(nodes)
    target = np.full(shards, total // shards, dtype=np.int64)
    target[np.argsort(-sizes, kind="stable")[: total % shards]] += 1
    excess, lack = np.maximum(0, sizes - target), np.maximum(0, target - sizes)
    ahead, before = np.cumsum(excess) - excess, np.cumsum(lack) - lack
    buckets = shuffle_partitions(nodes.sparkSession)
    bucket = F.col("spare").cast("int") * buckets + F.pmod(F.xxhash64("row"), F.lit(buckets))
    rows = with_row_number(nodes, "number", ["shard"], bucket, [F.col("row")])
    over = F.col("number") - _pick(target, F.col("shard"))
    index = over + _pick(ahead, F.col("shard"))
    to = sum(((index >= int(b)).cast("int") for b, n in zip(before, lack, strict=True) if n), F.lit(0)) - 1
    takers = np.flatnonzero(lack)
    new = _pick(takers, to) if len(takers) else F.lit(None).cast("int")
    slot = index - _pick(before[takers], to) + _pick(sizes[takers], to) if len(takers) else F.lit(None).cast("long")
    return rows.select(
        *[c for c in nodes.columns if c not in ("shard", "spare")],
        F.when(over >= 0, new).otherwise(F.col("shard")).alias("shard"),
        F.when(over >= 0, slot).otherwise(F.col("number")).cast("long").alias("slot"),
    )


def sharded(docs: DataFrame, shards: int = 40) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every
    document; equal texts are linked."""
    raw = F.coalesce("text", F.lit(""))
    nodes = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.xxhash64(raw).alias("group"),
        "doc_id",
        (F.octet_length(raw) + ROW_OVERHEAD).cast("long").alias("size"),
        F.crc32(raw.cast("binary")).alias("text_crc32"),
    )
    return assigned(nodes, shards).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
