"""SimHash near-duplicates found through Golay-code fuzzy keys.

A fingerprint has one bit per hash bit of its word shingles: 1 where over half
the shingles have it.  Fingerprints are cut into segments, a segment is decoded
to the indices of nearby codewords, and pairs of segments make keys.  Whatever
shares a key is compared; links become connected components.

* ``exact``: 64 bits in four segments of 16.  With at most three differing
  bits, some segment is equal while the one after it (in a circle) differs in
  one bit at most: each equal segment otherwise has a successor with two
  errors, so there is only one, and the three others hold four errors.  Keys
  are (segment, near index of the next segment); no link of 3 bits is missed.
* ``wide``: 128 bits, five segments of 23.  Keys are the near indices of two
  segments.  The radius is the distance expected at similarity 0.8, far beyond
  what pigeonholes guarantee, so a pair is found with the probability that two
  of the segments share an index: about 0.85 at 0.8, 0.98 at 0.9 (random
  errors).  An estimate; ``similar`` links by the similarity itself.

Null and empty texts have fingerprint zero and link like any other; repeated
rows have equal fingerprints; other columns of the input play no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfleet.llm.golay import BITS, INDEX_BITS, near_indices
from wayfleet.llm.work import batches, components, stored, text_bytes

#: A key with more fingerprints than this is compared block by block.
GROUP_ROWS = 1 << 18
_SMALL = 8
SEED = 42


@dataclass(frozen=True)
class Scheme:
    words: int
    parts: int  # 64-bit parts of a fingerprint
    radius: int


def exact() -> Scheme:
    return Scheme(words=3, parts=1, radius=3)


def wide(words: int = 5, similarity: float = 0.8) -> Scheme:
    """The radius is the expected distance at this Jaccard similarity."""
    angle = math.acos(2 * similarity / (1 + similarity))
    return Scheme(words=words, parts=2, radius=math.floor(128 * angle / math.pi))


# -- fingerprints ----------------------------------------------------------


def shingles(text: bytes, words: int) -> list[bytes]:
    """Word shingles of a text, A-Z in lower case; all words if there are fewer."""
    found = text.lower().split()
    if len(found) <= words:
        return [b" ".join(found)] if found else []
    return list(map(b" ".join, zip(*(found[i:] for i in range(words)), strict=False)))


def fingerprint(text: bytes, scheme: Scheme) -> bytes:
    """Big-endian bytes of the fingerprint."""
    size, found = 8 * scheme.parts, shingles(text, scheme.words)
    if not found:
        return bytes(size)
    digest = xxhash.xxh64_digest if scheme.parts == 1 else xxhash.xxh3_128_digest
    hashes = np.frombuffer(b"".join([digest(x, SEED) for x in found]), dtype=np.uint8)
    votes = np.zeros(8 * size, dtype=np.int64)
    hashes = hashes.reshape(-1, size)
    for start in range(0, len(hashes), 4096):
        bits = np.unpackbits(hashes[start : start + 4096], axis=1)
        votes += bits.sum(axis=0, dtype=np.uint16)
    return np.packbits(2 * votes > len(hashes)).tobytes()


def fingerprints(docs: DataFrame, scheme: Scheme, keep: list[str]) -> DataFrame:
    """``keep`` columns, the parts f0, f1, ... (long) of each row's fingerprint,
    and its node."""
    parts = [f"f{i}" for i in range(scheme.parts)]

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(source):
            prints = b"".join(fingerprint(x, scheme) for x in batch.column(len(keep)).to_pylist())
            values = np.frombuffer(prints, dtype=">i8").astype(np.int64).reshape(-1, scheme.parts)
            columns = [batch.column(i) for i in range(len(keep))]
            columns += [pa.array(np.ascontiguousarray(values[:, i])) for i in range(scheme.parts)]
            columns.append(pa.array(node_of(np.ascontiguousarray(values).view(np.uint64))))
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, *parts, "node"])

    narrow = docs.select(*[F.col(f"`{c}`") for c in keep], text_bytes().alias("__text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in narrow.schema[:-1])
    made = ", ".join(f"{p} long" for p in parts)
    return narrow.mapInArrow(run, f"{kinds}, {made}, node long")


def node_of(f: np.ndarray) -> np.ndarray:
    """One number for a fingerprint: itself, or a mix of its two parts."""
    if f.shape[1] == 1:
        return f[:, 0].view(np.int64)
    return (f[:, 0] ^ (f[:, 1] * np.uint64(0x9E3779B97F4A7C15))).view(np.int64)


# -- keys --------------------------------------------------------------------


def _keys_exact(f: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    rows, keys = [], []
    segments = [(f[:, 0] >> np.uint64(16 * i) & np.uint64(0xFFFF)).astype(np.int64) for i in range(4)]
    for i in range(4):
        near = near_indices(segments[(i + 1) % 4] << (BITS - 16))
        row, _ = at = np.nonzero(near >= 0)
        rows.append(row)
        keys.append(i << 28 | segments[i][row] << INDEX_BITS | near[at])
    return np.concatenate(rows), np.concatenate(keys)


def _keys_wide(f: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    low = np.uint64((1 << BITS) - 1)
    cut = lambda part, i: (f[:, part] >> np.uint64(BITS * i) & low).astype(np.int64)
    rest = (f[:, 0] >> np.uint64(46)) | ((f[:, 1] >> np.uint64(46)) & np.uint64(31)) << np.uint64(18)
    segments = [cut(0, 0), cut(0, 1), cut(1, 0), cut(1, 1), (rest & low).astype(np.int64)]
    near = [near_indices(s) for s in segments]
    rows, keys, pair = [], [], 0
    for i in range(5):
        for j in range(i):
            both = (near[i] >= 0)[:, :, None] & (near[j] >= 0)[:, None, :]
            row, x, y = np.nonzero(both)
            rows.append(row)
            keys.append(pair << 24 | near[i][row, x].astype(np.int64) << INDEX_BITS | near[j][row, y])
            pair += 1
    return np.concatenate(rows), np.concatenate(keys)


def fuzzy_keys(classes: DataFrame, scheme: Scheme) -> DataFrame:
    """A row for each key of each class: key and the fingerprint's parts."""
    parts = [f"f{i}" for i in range(scheme.parts)]
    make = _keys_exact if scheme.parts == 1 else _keys_wide

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches(source):
            for start in range(0, whole.num_rows, 2000):
                batch = whole.slice(start, 2000)
                f = np.stack([batch.column(i).to_numpy() for i in range(scheme.parts)], axis=1)
                row, key = make(f.view(np.uint64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key), *(pa.array(f[row, i]) for i in range(scheme.parts))], names=["key", *parts]
                )

    made = ", ".join(f"{p} long" for p in parts)
    return classes.select(*parts).mapInArrow(run, f"key long, {made}")


# -- links --------------------------------------------------------------------


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int32)


def _walk(node: np.ndarray, f: np.ndarray, radius: int) -> np.ndarray:
    """For each node, in ascending order, the smallest that links reach: each
    fingerprint reached looks at those not reached yet only, so a dense group
    costs little."""
    least, left = node.copy(), np.arange(len(node))
    while len(left):
        first, queue, left = left[0], [left[0]], left[1:]
        while queue and len(left):
            near = _distance(f[left], f[queue.pop()]) <= radius
            reached = left[near]
            least[reached] = node[first]
            queue += list(reached)
            left = left[~near]
    return least


def _links(key: np.ndarray, node: np.ndarray, f: np.ndarray, radius: int) -> np.ndarray:
    """(n, 2) nodes, each with the smallest that links within one key reach,
    where that is another one.  Rows are sorted by key and node."""
    start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    size = np.diff(np.r_[start, len(key)])
    least, small = node.copy(), np.repeat(size <= _SMALL, size)
    pairs = [np.empty((2, 0), dtype=np.int64)]
    for lag in range(1, min(_SMALL, len(key))):
        at = np.flatnonzero((key[lag:] == key[:-lag]) & small[lag:])
        at = at[_distance(f[at], f[at + lag]) <= radius]
        pairs.append(np.stack([at, at + lag]))
    one, two = np.concatenate(pairs, axis=1)
    while True:  # a key of this kind has few members, so few turns
        before = least.copy()
        np.minimum.at(least, one, least[two])
        np.minimum.at(least, two, least[one])
        if (before == least).all():
            break
    for k in np.flatnonzero(size > _SMALL):
        own = slice(start[k], start[k] + size[k])
        least[own] = _walk(node[own], f[own], radius)
    moved = least != node
    return np.stack([node[moved], least[moved]], axis=1)


def links(keys: DataFrame, scheme: Scheme, group_rows: int = GROUP_ROWS, classes: int | None = None) -> DataFrame:
    """Nodes (a, b), enough of them to connect whatever shares a key and lies
    within the radius: for each key, each node with the smallest that it reaches.

    Keys are dealt and sorted by Spark; a task streams over its sorted rows
    and holds one key's fingerprints.  Keys with more than ``group_rows`` are
    cut into blocks by fingerprint and every pair of blocks is a key of its
    own, so no task holds more, and no link is lost.  ``classes``: the number
    of fingerprints, if known; no key can have more.
    """
    parts = [f"f{i}" for i in range(scheme.parts)]
    if classes is None or classes > group_rows:
        counted = keys.groupBy("key").count().where(F.col("count") > group_rows)
        hot = counted.select("key", F.ceil(F.col("count") / (group_rows / 2)).cast("int").alias("__n"))
        keys = keys.join(hot, "key", "left")
        n, own = F.col("__n"), F.pmod(F.xxhash64(*parts), F.col("__n")).cast("int")
        blocks = F.when(
            n.isNotNull(),
            F.transform(
                F.sequence(F.lit(0), n - 1),
                lambda x: F.xxhash64("key", F.least(x, own), F.greatest(x, own)),
            ),
        ).otherwise(F.array("key"))
        keys = keys.select(F.explode(blocks).alias("key"), *parts)

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def out(rows: np.ndarray) -> pa.RecordBatch:
            f = rows[:, 1:].view(np.uint64)
            pairs = np.unique(_links(rows[:, 0], node_of(f), f, scheme.radius), axis=0)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.ascontiguousarray(pairs[:, i])) for i in (0, 1)], names=["a", "b"]
            )

        for batch in batches(source):
            rows = np.stack([batch.column(i).to_numpy() for i in range(1 + scheme.parts)], axis=1)
            if rows[0, 0] == rows[-1, 0]:
                if held and held[-1][-1, 0] != rows[0, 0]:
                    yield out(np.ascontiguousarray(np.concatenate(held)))
                    held = []
                held.append(rows)
                continue
            cut = np.searchsorted(rows[:, 0], rows[-1, 0])
            yield out(np.ascontiguousarray(np.concatenate([*held, rows[:cut]])))
            held = [rows[cut:]]
        if held:
            yield out(np.ascontiguousarray(np.concatenate(held)))

    dealt = keys.repartition("key").sortWithinPartitions("key", *parts)
    return dealt.mapInArrow(run, "a long, b long")


# -- whole operator ---------------------------------------------------------


def near_duplicates(docs: DataFrame, scheme: Scheme, group_rows: int = GROUP_ROWS) -> DataFrame:
    """doc_id, the fingerprint's parts and component_id of every row.

    component_id is the smallest doc_id that links reach, null only where all
    of those are null.  Equal fingerprints are one class from the start, so
    copies never meet in pairs.
    """
    parts = [f"f{i}" for i in range(scheme.parts)]
    rows, _ = stored(fingerprints(docs, scheme, ["doc_id"]), "prints")
    classes, _ = stored(rows.groupBy("node", *parts).agg(F.min("doc_id").alias("first_id")), "classes")
    pairs = links(fuzzy_keys(classes, scheme), scheme, group_rows, classes.count())
    roots = components(pairs)
    joined = classes.join(roots, "node", "left").select(
        "node", "first_id", F.coalesce("root", "node").alias("root")
    )
    ids = joined.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = joined.join(ids, "root").select("node", "component_id")
    return rows.join(named, "node").select("doc_id", *parts, "component_id")
