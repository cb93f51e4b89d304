"""Conflict-constrained best-fit packing of documents into fixed-size bins.

A document costs its words plus one separator.  Documents longer than a bin are
cut: whole-bin pieces fill bins of their own, the rest is packed like any other
piece.  Pieces go largest first into the bin with the least room that still
takes them, provided that it holds no piece of the same duplicate cluster
(equal texts) and fewer than ``per_source`` pieces of the same source.  Open
bins are kept in order of room left, each with bitmaps of its sources and
clusters; the search starts at the tightest bin with enough room and goes on to
the next until one is compatible.  With no such bin a new one is opened.

Packing is sequential, so documents are dealt into lanes of about
``lane_rows`` by a hash, and a task packs a lane at a time.  The number of lanes
follows the number of documents; every lane is packed whole.  The hash takes in
a number of the row, so that rows that are equal in everything are spread as well:
lanes follow the files and their order, and the same files give the same bins.
``docs`` should be read from files, whose order a lost task finds again.

Null and empty texts cost one separator.  A null source is a source of its own.
Rows repeated with one doc_id are separate documents of one cluster; which of two
equal rows goes first makes no difference.  Other columns, whatever their names,
are not read; an empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfleet.llm.work import batches

CAPACITY = 4096
PER_SOURCE = 4
LANE_ROWS = 3000


def word_count(column: str = "text") -> Column:
    """Number of words [^\\x20\\x09-\\x0D]+ of a text, 0 for null."""
    text = F.coalesce(F.col(column), F.lit(""))
    plain = F.translate(text, "\t\n\x0b\f\r", "     ")
    words = F.split(F.trim(plain), " +")
    return F.when(F.trim(plain) == "", 0).otherwise(F.size(words)).cast("long")


class Bins:
    """Bins of one lane, open ones ordered by the room they have left."""

    def __init__(self, capacity: int, per_source: int):
        self.capacity, self.per_source = capacity, per_source
        self.open: list[tuple[int, int]] = []  # (room, bin)
        self.sources: list[list[int]] = []  # for each bin a bitmap for each count reached
        self.clusters: list[int] = []
        self.count = 0

    def new(self) -> int:
        self.sources.append([0] * self.per_source)
        self.clusters.append(0)
        self.count += 1
        return self.count - 1

    def place(self, size: int, source: int, cluster: int) -> tuple[int, int]:
        """(bin, offset) for a piece; source and cluster are single-bit masks."""
        at, last = bisect_left(self.open, (size, -1)), self.per_source - 1
        while at < len(self.open):
            room, found = self.open[at]
            if not (self.sources[found][last] & source or self.clusters[found] & cluster):
                del self.open[at]
                break
            at += 1
        else:
            room, found = self.capacity, self.new()
        for level in range(self.per_source):
            if not self.sources[found][level] & source:
                self.sources[found][level] |= source
                break
        self.clusters[found] |= cluster
        if room > size:
            insort(self.open, (room - size, found))
        return found, self.capacity - room


def pack_lane(rows: list[tuple], capacity: int, per_source: int) -> list[tuple]:
    """rows: (number, size, source, cluster), any order that is the same each
    time.  Gives (number, piece, bin, offset, size)."""
    out, rest, bins = [], [], Bins(capacity, per_source)
    for number, size, source, cluster in rows:
        whole, left = divmod(size, capacity)
        for piece in range(whole):
            out.append((number, piece, bins.new(), 0, capacity))
        if left:
            rest.append((left, number, whole, source, cluster))
    rest.sort(key=lambda x: (-x[0], x[1]))
    often: dict = defaultdict(int)
    for x in rest:
        often[x[4]] += 1
    source_bit: dict = {}
    cluster_bit: dict = {}
    for size, number, piece, source, cluster in rest:
        mark = source_bit.setdefault(source, 1 << len(source_bit))
        copies = cluster_bit.setdefault(cluster, 1 << len(cluster_bit)) if often[cluster] > 1 else 0
        out.append((number, piece, *bins.place(size, mark, copies), size))
    return out


def packed(docs: DataFrame, capacity: int = CAPACITY, per_source: int = PER_SOURCE, lane_rows: int = LANE_ROWS) -> DataFrame:
    """doc_id, piece, lane, bin (within the lane), offset and size of every
    piece.  Offsets and sizes count words and separators."""
    narrow = docs.select(
        "doc_id",
        (word_count() + 1).alias("size"),
        F.col("source").cast("string").alias("source"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("cluster"),
    )
    lanes = max(1, -(-docs.count() // lane_rows))
    narrow = narrow.withColumn("row", F.monotonically_increasing_id())
    lane = F.pmod(F.xxhash64("doc_id", "cluster", "row"), F.lit(lanes)).cast("int")
    narrow = narrow.withColumn("lane", lane).drop("row")

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rows: list[dict]) -> pa.RecordBatch:
            found = pack_lane(
                [(k, r["size"], r["source"], r["cluster"]) for k, r in enumerate(rows)], capacity, per_source
            )
            number, piece, found_in, offset, size = zip(*found, strict=True)
            return pa.RecordBatch.from_pydict(
                {
                    "doc_id": pa.array([rows[k]["doc_id"] for k in number], pa.int64()),
                    "piece": pa.array(piece, pa.int32()),
                    "lane": pa.array([rows[0]["lane"]] * len(number), pa.int32()),
                    "bin": pa.array(found_in, pa.int32()),
                    "offset": pa.array(offset, pa.int32()),
                    "size": pa.array(size, pa.int32()),
                }
            )

        held: list[dict] = []
        for batch in batches(source):
            for row in batch.to_pylist():
                if held and held[0]["lane"] != row["lane"]:
                    yield out(held)
                    held = []
                held.append(row)
        if held:
            yield out(held)

    dealt = narrow.repartition("lane").sortWithinPartitions("lane", "doc_id", "cluster", "source")
    return dealt.mapInArrow(run, "doc_id long, piece int, lane int, bin int, offset int, size int")
