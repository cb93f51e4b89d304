"""Quality rules: statistics of a text and the frequency of its lines elsewhere.

Lines are normalised (lower case, digits as 0, runs of white space as one
blank) and hashed.  A line that occurs in more than ``MOST_DOCS`` documents of a
host is removed from each of them; for a line of which some document holds fewer
than ``SHORT_WORDS`` words the limit is ``MOST_DOCS_SHORT``, as headings and dates
repeat by themselves.  The limits are numbers, not shares: what a large host has
copied is judged as in a small one.  A document that keeps less than
``LEAST_KEPT`` of its words is depleted and rejected.  Line counts are made of the
distinct lines of each document, added up before they are shuffled, so a line that
every document has costs one row for each task.

Hosts are the values of a column; null is a host of its own.  Null and empty
texts have no words and fail the base rule.  Rows repeated with one doc_id are
separate documents.  Ties do not matter: limits are on counts.  Other columns,
whatever their names, are not read; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfleet.llm.work import batches, broadcast_if_few, stored, text_bytes

LEAST_WORDS = 50
MOST_DOCS = 20
SHORT_WORDS, MOST_DOCS_SHORT = 4, 200
LEAST_KEPT = 0.3
_SYMBOLS = b"#*$%&|<>"
_DIGITS = bytes.maketrans(b"123456789", b"000000000")


def repeated_words(words: list[bytes], window: int = 3) -> int:
    """Words that lie in a window of words found twice or more in the text."""
    if len(words) <= window:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), dtype=np.int64, count=len(words))
    key = ids[: len(ids) - window + 1].copy()
    for i in range(1, window):
        if len(number) ** (i + 1) < 1 << 62:
            key = key * len(number) + ids[i : i + len(key)]
        else:  # number the pairs anew so that they fit
            _, key = np.unique(key, return_inverse=True)
            key = key * len(number) + ids[i : i + len(key)]
    _, inverse, count = np.unique(key, return_inverse=True, return_counts=True)
    often = count[inverse] > 1
    inside = np.zeros(len(ids), dtype=bool)
    for i in range(window):
        inside[i : i + len(key)] |= often
    return int(inside.sum())


def base_statistics(text: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words."""
    words = text.split()
    joined = b"".join(words)
    chars = len(joined.decode("utf-8", "replace"))
    symbols = len(joined) - len(joined.translate(None, _SYMBOLS))
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated_words(words)


def line_words(text: bytes) -> dict[int, int]:
    """Words of each distinct normalised line, by the line's hash."""
    out: dict[int, int] = {}
    for line in text.lower().translate(_DIGITS).split(b"\n"):
        words = line.split()
        if words:
            key = xxhash.xxh64_intdigest(b" ".join(words)) - (1 << 63)
            out[key] = out.get(key, 0) + len(words)
    return out


_BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def with_lines(docs: DataFrame, host: str = "source") -> DataFrame:
    """row, doc_id, host, the base statistics, and (line, words) of each row."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(source):
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                texts = part.column(3).to_pylist()
                base = np.array([base_statistics(x) for x in texts], dtype=np.int64)
                lines = [[{"line": k, "words": n} for k, n in line_words(x).items()] for x in texts]
                kind = pa.list_(pa.struct([("line", pa.int64()), ("words", pa.int64())]))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(i) for i in range(3)), *(pa.array(base[:, i]) for i in range(5)), pa.array(lines, kind)],
                    names=["row", "doc_id", "host", *_BASE, "lines"],
                )

    narrow = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), F.col(host).cast("string").alias("host"), text_bytes().alias("text")
    )
    base = ", ".join(f"{x} long" for x in _BASE)
    return narrow.mapInArrow(run, f"row long, doc_id long, host string, {base}, lines array<struct<line:bigint,words:bigint>>")


def judged(
    docs: DataFrame,
    host: str = "source",
    most_docs: int = MOST_DOCS,
    most_docs_short: int = MOST_DOCS_SHORT,
    least_kept: float = LEAST_KEPT,
) -> DataFrame:
    """doc_id, the base statistics, base_failed, n_removed_words and kept of
    every row."""
    rows, _ = stored(with_lines(docs, host), "lines")
    lines = rows.select("host", "row", F.explode("lines").alias("x")).select("host", "row", "x.line", "x.words")
    counted = lines.groupBy("host", "line").agg(F.count(F.lit(1)).alias("n"), F.min("words").alias("least"))
    limit = F.when(F.col("least") < SHORT_WORDS, most_docs_short).otherwise(most_docs)
    common, _ = stored(
        counted.where(F.col("n") > limit).select(F.col("host").alias("common_host"), F.col("line").alias("common_line")),
        "common-lines",
    )
    common = broadcast_if_few(common)
    removed = lines.join(
        common, (lines["line"] == common["common_line"]) & lines["host"].eqNullSafe(common["common_host"])
    ).groupBy("row").agg(F.sum("words").alias("n_removed_words"))
    lost = F.coalesce("n_removed_words", F.lit(0))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return rows.drop("lines").join(removed, "row", "left").select(
        "doc_id",
        *_BASE,
        failed.alias("base_failed"),
        lost.alias("n_removed_words"),
        (~failed & (F.col("n_words") - lost >= least_kept * F.col("n_words"))).alias("kept"),
    )
