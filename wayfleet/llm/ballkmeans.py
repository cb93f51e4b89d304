"""Compression of vectors to one byte per part, codebooks by ball k-means.

Vectors are integers, cut into equal consecutive parts; each part position has
a codebook.  Rounds are exact: every part goes to its nearest entry (ties to the
lower index), every entry becomes the floor of its parts' mean.

The first assignment compares with all entries.  Later ones use the balls of
ball k-means.  The parts an entry won last time form its ball around the entry
as it is now, whose radius is their largest distance.  An entry is a neighbour
if it lies within two radii: farther ones cannot win a part of this ball.  A
part less than half as far from its entry as the nearest neighbour is belongs
to the stable core and is compared with none; beyond, the distances of the
neighbours cut the ball into rings, and a part is compared with exactly those
at up to twice its own distance.  All comparisons are between integers, so ties
are kept exactly.

Balls are made of the rows of one batch: a ball of fewer parts has a smaller
radius and excludes more, and results do not depend on it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfleet.llm.vectors import integer_vectors, length, matrix
from wayfleet.llm.work import batches, forget, join_skewed, stored

FACTOR, PARTS, ENTRIES, ROUNDS = 1024, 4, 256, 4
_BLOCK = 16
_ROWS = 8192


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows of ``a`` to rows of ``b``, as integers."""
    found = np.einsum("ij,ij->i", a, a)[:, None] + np.einsum("ij,ij->i", b, b) - 2 * (a @ b.T)
    return found.astype(np.int64)


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry (lowest of equals) and squared distance."""
    away = squared(x, book)
    code = away.argmin(axis=1)
    return code, away[np.arange(len(x)), code]


def ball_nearest(x: np.ndarray, book: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """As ``nearest``, starting from the codes of the last round; also how many
    distances between parts and other entries were computed."""
    size = len(book)
    own = np.einsum("ij,ij->i", x - book[code], x - book[code]).astype(np.int64)
    best, computed = own * size + code, 0  # distance and index in one number
    between = squared(book, book)
    by_entry = np.lexsort((own, code))
    start = np.searchsorted(code[by_entry], np.arange(size + 1))
    for e in range(size):
        members = by_entry[start[e] : start[e + 1]]
        if not len(members):
            continue
        radius = own[members[-1]]
        near = np.flatnonzero(between[e] <= 4 * radius)
        near = near[near != e]
        near = near[np.argsort(between[e][near], kind="stable")]
        # Ring of each member: how many neighbours it must be compared with.
        ring = np.searchsorted(between[e][near], 4 * own[members], side="right")
        for first in range(0, int(ring[-1]), _BLOCK):
            outer = np.searchsorted(ring, first, side="right")
            block = near[first : first + _BLOCK]
            away = squared(x[members[outer:]], book[block]) * size + block
            asked = np.arange(first, first + len(block)) < ring[outer:, None]
            away = np.where(asked, away, np.iinfo(np.int64).max)
            best[members[outer:]] = np.minimum(best[members[outer:]], away.min(axis=1))
            computed += int(asked.sum())
    return best % size, best // size, computed


def _cut(v: list[bytes], width: int, parts: int) -> list[np.ndarray]:
    return np.split(matrix(v, width), parts, axis=1)


def assigned(rows: DataFrame, books: list[np.ndarray], width: int) -> DataFrame:
    """The rows with ``codes`` and ``error`` under the codebooks; existing codes
    (null at first) are where the search starts."""
    names = rows.columns
    at_v, at_codes = names.index("v"), names.index("codes")
    kept = [i for i, n in enumerate(names) if n not in ("codes", "error")]

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches(source):
            for start in range(0, whole.num_rows, _ROWS):
                batch = whole.slice(start, _ROWS)
                parts = _cut(batch.column(at_v).to_pylist(), width, len(books))
                before = batch.column(at_codes).to_pylist()
                codes = np.zeros((batch.num_rows, len(books)), dtype=np.uint8)
                error = np.zeros(batch.num_rows, dtype=np.int64)
                last = None if before[0] is None else np.frombuffer(b"".join(before), np.uint8).reshape(codes.shape)
                for i, (x, book) in enumerate(zip(parts, books, strict=True)):
                    if last is None:
                        codes[:, i], away = nearest(x, book)
                    else:
                        codes[:, i], away, _ = ball_nearest(x, book, last[:, i].astype(np.int64))
                    error += away
                columns = [batch.column(i) for i in kept]
                columns += [pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(error)]
                yield pa.RecordBatch.from_arrays(columns, names=[*(names[i] for i in kept), "codes", "error"])

    kinds = ", ".join(f"`{names[i]}` {rows.schema[i].dataType.simpleString()}" for i in kept)
    return rows.mapInArrow(run, f"{kinds}, codes binary, error long")


def moved(rows: DataFrame, books: list[np.ndarray], width: int) -> list[np.ndarray]:
    """The codebooks with each entry the floor of its parts' mean; an entry
    without parts stays.  Each task sends one row of sums per entry it saw."""
    size, step = len(books[0]), width // len(books)

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros((len(books), size), dtype=np.int64)
        total = np.zeros((len(books), size, step), dtype=np.int64)
        for batch in batches(source):
            codes = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(-1, len(books))
            for i, x in enumerate(_cut(batch.column(0).to_pylist(), width, len(books))):
                count[i] += np.bincount(codes[:, i], minlength=size)
                for j in range(step):
                    total[i, :, j] += np.bincount(codes[:, i], weights=x[:, j], minlength=size).astype(np.int64)
        part, entry = np.nonzero(count)
        columns = [pa.array(part), pa.array(entry), pa.array(count[part, entry])]
        columns += [pa.array(np.ascontiguousarray(total[part, entry, j])) for j in range(step)]
        yield pa.RecordBatch.from_arrays(columns, names=["part", "entry", "n", *(f"s{j}" for j in range(step))])

    sums = "".join(f", s{j} long" for j in range(step))
    partial = rows.select("v", "codes").mapInArrow(run, f"part long, entry long, n long{sums}")
    out = [book.copy() for book in books]
    found = partial.groupBy("part", "entry").agg(F.sum("n"), *[F.sum(f"s{j}") for j in range(step)])
    for part, entry, n, *total in found.collect():  # at most parts x entries rows
        out[part][entry] = [t // n for t in total]
    return out


def compressed(
    embeddings: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, keep: tuple[str, ...] = ()
) -> tuple[DataFrame, list[np.ndarray]]:
    """vec_id, ``keep`` columns, codes (one byte per part) and error of each row
    with a whole vector, and the final codebooks.

    Codebooks begin with the parts of the rows of smallest vec_id (then by
    vector; rows without an id last).  Vectors whose length the number of parts
    does not divide, or that are shorter than others, count as ended by zeros.
    An empty table gives no rows and empty codebooks."""
    if not 0 < entries <= 256:
        raise ValueError("a code is one byte: 1 to 256 entries")
    spark = embeddings.sparkSession
    rows, path = stored(integer_vectors(embeddings, FACTOR, ["vec_id", *keep]), "vectors")
    width = -(-length(rows) // parts) * parts
    # Only ids are sorted here; a row of vectors is read where its id is small.
    order = [F.col("vec_id").asc_nulls_last()]
    small = [r[0] for r in rows.select("vec_id").orderBy(*order).limit(entries).collect()]
    known = [x for x in small if x is not None]
    few = rows if len(known) < len(small) else rows.where(F.col("vec_id") <= max(known, default=0))
    first = [bytes(r[0]) for r in few.select("v", "vec_id").orderBy(*order, "v").limit(entries).select("v").collect()]
    books = _cut(first, width, parts) if first and width else [np.zeros((1, 0))] * parts
    rows = rows.withColumns({"codes": F.lit(None).cast("binary"), "error": F.lit(0).cast("long")})
    if not first:
        return rows.drop("v"), [np.zeros((0, 0))] * parts
    for _ in range(rounds):
        now, new = stored(assigned(rows, books, width), "codes")
        forget(spark, path)
        rows, path, books = now, new, moved(now, books, width)
    return assigned(rows, books, width).drop("v"), books


def digest(books: list[np.ndarray]) -> str:
    """Hex SHA-256 of all components in decimal, joined by commas."""
    flat = ",".join(str(int(x)) for book in books for x in book.ravel())
    return hashlib.sha256(flat.encode()).hexdigest()


def coded_table(embeddings: DataFrame) -> DataFrame:
    """vec_id, code (hex), error, label_error (summed over equal labels, nulls
    together) and codebooks_sha256."""
    found, books = compressed(embeddings, keep=("label",))
    key = F.coalesce(F.concat(F.lit("="), F.col("label").cast("string")), F.lit(""))
    rows, _ = stored(found.withColumn("__label", key), "coded")
    totals = rows.groupBy("__label").agg(F.sum("error").alias("label_error"))
    return join_skewed(rows, totals, "__label").select(
        "vec_id",
        F.lower(F.hex("codes")).alias("code"),
        "error",
        "label_error",
        F.lit(digest(books)).alias("codebooks_sha256"),
    )
