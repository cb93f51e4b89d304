"""Importance resampling towards a target: documents whose n-grams are more
frequent in the target texts than in the corpus are drawn more often.

Texts are lower-cased (A-Z only), separators collapse to single spaces, and for
each length an overlapped scan, held to word boundaries by look-arounds, emits
the spans of the runs of so many words.  A feature is the CRC-32 of a span's
UTF-8 bytes modulo ``BUCKETS``.  Scanning is the expensive part and is done
once: each document's buckets are stored, sorted, as differences in two byte
planes, and both the corpus counts and the weights are made from them.

A document's weight is the sum of the gains of its features' buckets, and the
draw adds Gumbel noise made of its id, so the highest scores are a sample
without replacement in proportion to exp(weight / 1000).

Null and empty texts, and those without a word, have no features and weight 0;
a null doc_id counts as an empty one in the noise and comes last among ties.
Repeated rows are documents of their own with equal scores, drawn one after the
other in no particular order.  An empty corpus gives no rows, an empty target
negative gains; other columns play no part.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfleet.llm.work import batches, stored, text_bytes, with_rank

BUCKETS, LENGTHS, LEAST_WORDS, PERCENT, SEED = 10_000, 3, 20, 5, 42
#: Bytes that are no part of a word: ASCII but for digits and small letters.
_SPACES = bytes(
    32 if b < 128 and not (48 <= b <= 57 or 97 <= b <= 122) else b for b in range(256)
)
_SCANS = [regex.compile(rb"(?<![^ ])[^ ]+" + rb" [^ ]+" * n + rb"(?![^ ])") for n in range(LENGTHS)]


def words_only(text: bytes) -> bytes:
    """Words of the text, single spaces between them."""
    return b" ".join(text.lower().translate(_SPACES).split())


def spans(text: bytes) -> Iterator[tuple[int, int]]:
    """Start and end of every run of 1 to ``LENGTHS`` words of ``words_only``."""
    for scan in _SCANS:
        for match in scan.finditer(text, overlapped=True):
            yield match.span()


def buckets(text: bytes) -> np.ndarray:
    """Sorted buckets of all features of a text."""
    clean, crc = words_only(text), zlib.crc32
    found = [crc(m.group()) for scan in _SCANS for m in scan.finditer(clean, overlapped=True)]
    return np.sort(np.array(found, dtype=np.uint32) % BUCKETS)


def packed(found: np.ndarray) -> bytes:
    """Sorted buckets as differences: all low bytes, then all high ones."""
    steps = np.diff(found, prepend=0).astype("<u2")
    return steps.view(np.uint8).reshape(-1, 2).T.tobytes()


def unpacked(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(raw, dtype=np.uint8).reshape(2, -1).astype(np.int64)
    return np.cumsum(planes[0] + 256 * planes[1])


def features(texts: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns, n_words, n_features and packed buckets of each row."""
    names = [f"k{i}" for i in range(len(keep))]

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches(source):
            for start in range(0, whole.num_rows, 500):
                batch = whole.slice(start, 500)
                found = [buckets(x) for x in batch.column(len(names)).to_pylist()]
                size = np.array([len(x) for x in found], dtype=np.int64)
                # n words have n + (n - 1) + (n - 2) runs of up to three.
                words = np.where(size > 3, size // 3 + 1, (size + 1) // 2)
                columns = [batch.column(i) for i in range(len(names))]
                columns += [pa.array(words), pa.array(size), pa.array([packed(x) for x in found], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=[*names, "n_words", "n_features", "buckets"])

    narrow = texts.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(keep, names, strict=True)], text_bytes())
    kinds = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in narrow.schema[:-1])
    made = narrow.mapInArrow(run, f"{kinds}n_words long, n_features long, buckets binary")
    return made.withColumnsRenamed(dict(zip(names, keep, strict=True)))


def bucket_counts(rows: DataFrame) -> np.ndarray:
    """Features in each bucket over all rows; a task sends one row per bucket."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches(source):
            for raw in batch.column(0).to_pylist():
                total += np.bincount(unpacked(raw), minlength=BUCKETS)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["bucket", "n"])

    counts = np.zeros(BUCKETS, dtype=np.int64)
    partial = rows.select("buckets").mapInArrow(run, "bucket long, n long")
    for bucket, n in partial.groupBy("bucket").agg(F.sum("n")).collect():  # at most BUCKETS rows
        counts[bucket] = n
    return counts


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of both frequencies, one added to each bucket."""
    s_all, t_all = int(source.sum()), int(target.sum())
    return np.array(
        [
            math.floor(1000 * math.log((int(t) + 1) * (s_all + BUCKETS) / ((int(s) + 1) * (t_all + BUCKETS))))
            for s, t in zip(source, target, strict=True)
        ],
        dtype=np.int64,
    )


def weighted(rows: DataFrame, gain: np.ndarray) -> DataFrame:
    """``rows`` with weight in place of buckets."""
    names = [c for c in rows.columns if c != "buckets"]

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(source):
            weight = [int(gain[unpacked(raw)].sum()) for raw in batch.column(len(names)).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(len(names))), pa.array(weight, pa.int64())], names=[*names, "weight"]
            )

    kinds = ", ".join(f"`{n}` {rows.schema[n].dataType.simpleString()}" for n in names)
    return rows.select(*names, "buckets").mapInArrow(run, f"{kinds}, weight long")


def noise() -> Column:
    """Thousandths of a Gumbel variable made of the doc_id."""
    text = F.concat(F.lit(f"{SEED}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0)))


def resampled(docs: DataFrame, target: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_features, weight, score and rank (null if not drawn) of every
    document; ``percent`` of those with ``LEAST_WORDS`` words are drawn."""
    rows, _ = stored(features(docs, ["doc_id"]), "features")
    gain = gains(bucket_counts(rows), bucket_counts(features(target, [])))
    scored = weighted(rows, gain).withColumn("score", F.col("weight") + noise())
    enough = F.col("n_words") >= LEAST_WORDS
    ranked = with_rank(
        scored.withColumn("__enough", enough),
        "rank",
        [F.desc("__enough"), F.desc("score"), F.col("doc_id").asc_nulls_last()],
    )
    drawn = rows.where(enough).count() * percent // 100
    rank = F.when(F.col("__enough") & (F.col("rank") <= drawn), F.col("rank"))
    return ranked.select("doc_id", "n_features", "weight", "score", rank.alias("rank"))
