"""Removal of byte strings that occur more than once, exact over all documents.

Every byte covered by a LENGTH-byte string that also starts anywhere else is
removed.  The work is that of a suffix array with common-prefix values, cut down
to what can matter:

1. *Sampled suffixes.*  Each window of LENGTH bytes is represented by one
   position in it, the leftmost with the smallest hash of GRAM bytes.  Equal
   windows choose the same position, so only positions whose grams are
   repeated can begin a repeat.  About one position in fifty is sampled.
2. *Names.*  Sampled positions are named by their gram, then by all the bytes of
   the windows that they represent.  A name of the second kind that occurs
   twice settles all its windows: they are repeated.
3. *Induction.*  Where a gram is repeated but some surroundings occur once (the
   edges of a repeated passage), the windows around one position of each
   name are compared through their own hashes, from the sampled position
   outwards.

Sorting and merging is done by Spark's shuffles, which spill to disk; counts are
added up before they are shuffled, joins that carry rows are of a kind whose
skewed parts Spark splits, and a task hands on a window once, however often it
has met it.  Equality is that of a pair of independent 64-bit
hashes of the bytes.

Null and empty texts, and those shorter than LENGTH, keep all bytes.  Rows
repeated with one doc_id and text are separate documents, so they remove each
other.  Documents are read in pieces of PIECE bytes, so a very long text
needs no more memory.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wayfleet.llm.work import batches, forget, stored, text_bytes

LENGTH, GRAM = 200, 100
PIECE = 1 << 19
_POSITION = np.uint64((1 << 32) - 1)


class Hashes:
    """Two polynomial hashes of substrings modulo 2^64, from running sums."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.of_byte = rng.integers(1, 1 << 63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.base = int(rng.integers(1 << 40, 1 << 62)) * 4 + 3
        self.inverse = pow(self.base, -1, 1 << 64)
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.up) < n:
            size = 1 << (n - 1).bit_length()
            for name, base in (("up", self.base), ("down", self.inverse)):
                powers = np.full(size, base, dtype=np.uint64)
                powers[0] = 1
                setattr(self, name, np.multiply.accumulate(powers))

    def sums(self, data: np.ndarray) -> np.ndarray:
        self._powers(len(data) + 1)
        out = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(self.of_byte[data] * self.up[: len(data)], out=out[1:])
        return out

    def at(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of data[start:end], the same wherever the bytes lie."""
        return mixed((sums[end] - sums[start]) * self.down[start])

    def all(self, sums: np.ndarray, size: int) -> np.ndarray:
        n = len(sums) - size
        return mixed((sums[size:] - sums[:n]) * self.down[:n])


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_grams, _spans = Hashes(1), Hashes(2)


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    done = 1
    while done < width:
        step = min(done, width - done)
        x = np.minimum(x[: len(x) - step], x[step:])
        done += step
    return x


def _pieces(texts: list[bytes], length: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """Lists of (text, offset, bytes) of about PIECE bytes together.  A piece has
    the windows that begin in PIECE bytes from its offset, a multiple of it."""
    held, size = [], 0
    for k, text in enumerate(texts):
        for offset in range(0, max(0, len(text) - length + 1), PIECE):
            part = text[offset : offset + PIECE + length - 1]
            held.append((k, offset, part))
            size += len(part)
            if size >= PIECE:
                yield held
                held, size = [], 0
    if held:
        yield held


def sampled(pieces: list[tuple[int, int, bytes]], length: int, gram: int) -> dict[str, np.ndarray]:
    """Sampled positions: text, gram hash, name, and in the text the position
    and the first and last window that it represents."""
    sizes = np.array([len(p) for _, _, p in pieces])
    starts = np.cumsum(sizes) - sizes
    data = np.frombuffer(b"".join(p for _, _, p in pieces), dtype=np.uint8)
    hashes = _grams.all(_grams.sums(data), gram)
    order = (hashes & ~_POSITION) | np.arange(len(hashes), dtype=np.uint64)
    least = _sliding_min(order, length - gram + 1)
    # Windows that lie in one piece; their sampled positions come in runs.
    window = np.concatenate([np.arange(a, a + n - length + 1) for a, n in zip(starts, sizes, strict=True)])
    owner = np.repeat(np.arange(len(pieces)), sizes - length + 1)
    at = (least[window] & _POSITION).astype(np.int64)
    first = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (owner[1:] != owner[:-1])])
    last = np.r_[first[1:], len(at)] - 1
    at, low, high, owner = at[first], window[first], window[last], owner[first]
    sums = _spans.sums(data)
    name = _spans.at(sums, low, high + length)
    name = mixed(name + (at - low).astype(np.uint64) * np.uint64(1 << 20) + (high - low).astype(np.uint64))
    shift = np.array([o for _, o, _ in pieces])[owner] - starts[owner]
    return {
        "text": np.array([k for k, _, _ in pieces])[owner],
        "gram": hashes[at].view(np.int64),
        "name": name.view(np.int64),
        "at": at + shift,
        "low": low + shift,
        "high": high + shift,
    }


def _keyed(docs: DataFrame) -> DataFrame:
    """key, doc_id and text: rows with one id and text have one key."""
    text = text_bytes()
    return docs.select(F.xxhash64("doc_id", F.md5(text)).alias("key"), "doc_id", text.alias("text"))


def _samples(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """gram, name, key and place of every sampled position; a place packs the
    position with how far before it the first of its windows begins, and how
    many more there are (each below 1024)."""
    if length - gram >= 1024:
        raise ValueError("grams may be at most 1023 bytes shorter than strings")

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(source):
            for start in range(0, batch.num_rows, 2000):
                part = batch.slice(start, 2000)
                keys = part.column(0).to_numpy()
                for pieces in _pieces(part.column(1).to_pylist(), length):
                    found = sampled(pieces, length, gram)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(found["gram"]),
                            pa.array(found["name"]),
                            pa.array(keys[found["text"]]),
                            pa.array(found["at"] << 20 | (found["at"] - found["low"]) << 10 | found["high"] - found["low"]),
                        ],
                        names=["gram", "name", "key", "place"],
                    )

    return docs.where(F.octet_length("text") >= length).select("key", "text").mapInArrow(
        run, "gram long, name long, key long, place long"
    )


def _at(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Position, first and last window of packed places."""
    at = place >> 20
    low = at - (place >> 10 & 1023)
    return at, low, low + (place & 1023)


def _windows_of(text: bytes, edges: pa.StructArray, length: int) -> tuple[np.ndarray, ...]:
    """gram, hash of bytes and offset, first byte, and whether its name occurs
    once, of every window around the edge positions of one text."""
    gram, place, single = (edges.field(i).to_numpy(zero_copy_only=False) for i in range(3))
    at, low, high = _at(place)
    order = np.argsort(low, kind="stable")
    value, begin = [], 0
    while begin < len(order):  # edges that lie together share running sums
        base, end = low[order[begin]], begin + 1
        while end < len(order) and high[order[end]] + length - base <= 2 * PIECE:
            end += 1
        mine = order[begin:end]
        begin = end
        data = np.frombuffer(text[base : int(high[mine].max()) + length], dtype=np.uint8)
        count = high[mine] - low[mine] + 1
        which = np.repeat(mine, count)
        window = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + low[which]
        own = _spans.at(_spans.sums(data), window - base, window - base + length)
        own = mixed(own + (at[which] - window).astype(np.uint64))
        value.append((gram[which], own.view(np.int64), window, single[which]))
    return tuple(np.concatenate(x) for x in zip(*value, strict=True))


def _edge_windows(docs: DataFrame, edges: DataFrame, length: int) -> DataFrame:
    """Windows around edge positions: gram, window (a hash of bytes and offset),
    key, low, n and kind.  ``single``: its name occurs once; ``settled``: it was
    met twice in one task's batch, so it needs no one else; ``other``: it only
    counts, n times.  A batch hands on one row that is not settled for each
    window, however often it was met, and settled ones go anywhere."""
    listed = edges.groupBy("key").agg(F.collect_list(F.struct("gram", "place", "single")).alias("edges"))

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(source):
            found = [[], [], [], [], []]
            keys, texts, own = batch.column(0).to_numpy(), batch.column(1), batch.column(2)
            for row in range(batch.num_rows):
                columns = _windows_of(texts[row].as_py(), own.slice(row, 1).flatten(), length)
                for into, values in zip(found, (*columns, np.full(len(columns[0]), keys[row])), strict=True):
                    into.append(values)
            gram, window, low, single, key = map(np.concatenate, found)
            pair = np.rec.fromarrays([gram, window])
            _, first, inverse, count = np.unique(pair, return_index=True, return_inverse=True, return_counts=True)
            often = count[inverse] > 1
            alone, settled, lead = ~often, often & single, first[count > 1]
            parts = [
                (gram[alone], window[alone], key[alone], low[alone], np.ones(alone.sum(), np.int64), np.where(single[alone], 1, 0)),
                (key[settled], low[settled], key[settled], low[settled], np.ones(settled.sum(), np.int64), np.full(settled.sum(), 2)),
                (gram[lead], window[lead], key[lead], low[lead], count[count > 1], np.zeros(len(lead), np.int64)),
            ]
            names = ["gram", "window", "key", "low", "n", "kind"]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).astype(np.int64)) for x in zip(*parts, strict=True)], names=names)

    once = docs.select("key", "text").join(listed, "key")
    made = once.mapInArrow(run, "gram long, window long, key long, low long, n long, kind long")
    return made.withColumn("n", F.col("n").cast("int")).withColumn("kind", F.col("kind").cast("int"))


def repeated_windows(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """key and spans (low, high): all windows that begin from low to high are
    repeated.  A document has no more spans than bytes."""
    spark, keyed = docs.sparkSession, _keyed(docs)
    samples = _samples(keyed, length, gram)
    again = samples.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("gram")
    found, one = stored(samples.join(again, "gram", "left_semi"), "samples")
    names, two = stored(
        found.groupBy("gram", "name").agg(
            F.count(F.lit(1)).alias("n"), F.min(F.struct("key", "place")).alias("first")
        ),
        "names",
    )
    low = F.shiftright("place", 20) - F.shiftright("place", 10).bitwiseAND(F.lit(1023))
    whole = found.join(names.where("n > 1").select("gram", "name"), ["gram", "name"], "left_semi")
    whole = whole.select("key", low.alias("low"), (low + F.col("place").bitwiseAND(F.lit(1023))).alias("high"))
    several = names.groupBy("gram").agg(F.count(F.lit(1)).alias("names"), F.min("n").alias("least"))
    several = several.where("names > 1 AND least = 1").select("gram")
    edges = names.join(several, "gram", "left_semi").select("gram", "first.*", (F.col("n") == 1).alias("single"))
    # Rows with one key are equal and repeat each other, so that their windows
    # count twice here does no harm: their names are not single.
    windows = _edge_windows(keyed, edges, length)
    total = F.sum("n").over(Window.partitionBy("gram", "window"))
    some = windows.withColumn("total", total).where("kind = 2 OR kind = 1 AND total > 1")
    spans, three = stored(whole.unionByName(some.select("key", "low", F.col("low").alias("high"))), "repeats")
    forget(spark, one, two)
    spans, _ = stored(spans.groupBy("key").agg(F.collect_list(F.struct("low", "high")).alias("spans")), "spans")
    forget(spark, three)
    return spans


def without_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans (maximal removed runs) and kept (the
    remaining bytes, concatenated) of every row."""
    spans = repeated_windows(docs, length, gram)

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(source):
            rows = {"n_bytes": [], "n_removed": [], "n_spans": [], "kept": []}
            for row in range(batch.num_rows):
                text, kept, runs = batch.column(1)[row].as_py(), None, 0
                own = batch.column(2).slice(row, 1)
                if own.is_valid()[0].as_py():
                    low, high = (own.flatten().field(i).to_numpy() for i in (0, 1))
                    kept, runs = _cut(text, low, high + length)
                kept = text if kept is None else kept
                for name, value in zip(rows, (len(text), len(text) - len(kept), runs, kept), strict=True):
                    rows[name].append(value)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(rows[x], pa.int64()) for x in list(rows)[:3]), pa.array(rows["kept"], pa.binary())],
                names=["doc_id", *rows],
            )

    return _keyed(docs).join(spans, "key", "left").select("doc_id", "text", "spans").mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    )


def _cut(text: bytes, start: np.ndarray, end: np.ndarray) -> tuple[bytes, int]:
    """The bytes outside the spans, and the number of runs that the spans form."""
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(end[order])
    new = np.flatnonzero(np.r_[True, start[1:] > reach[:-1]])
    first, last = start[new], reach[np.r_[new[1:] - 1, len(reach) - 1]]
    edges = [0, *np.stack([first, last], axis=1).ravel().tolist(), len(text)]
    return b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)), len(new)
