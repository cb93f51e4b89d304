"""Quality classifier: a regularised quadratic discriminant over document statistics.

Each class of the label has a Gaussian over transformed statistics of the text.
Its covariance is shrunk towards the pooled variances; the score is the
logistic value of the difference of log densities (Mahalanobis terms from
Cholesky factors computed once) plus the log prior ratio.

All labelled training rows count: tasks make sums and products of their rows,
Spark adds them up, and the driver receives one number for each class and pair
of statistics.  Null and empty texts have defined statistics; null labels and
labels of unknown documents are left out; of several labels of one doc_id the
largest counts.  With no training row in one class, every score is the share of
label 1 among the training rows (0.5 without any).
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfleet.llm.work import batches, text_bytes, unused

FOLDS = 5
THRESHOLD = 0.3
SHRINKAGE = 0.15
_FLOOR = 1e-3

_CLASSES = (
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    b"0123456789",
    b".,;:?",
    b"!",
    b"#*$%&|<>",
    b" \t\n\r\v\f",
)
NAMES = (
    "log_words log_line word_length word_length_spread upper digits punctuation "
    "exclamations symbols spaces variety top_word repeated_next dup_lines compression"
).split()


def statistics(text: bytes) -> list[float]:
    """The transformed statistics of one text, in the order of NAMES."""
    words = text.split()
    lines = [x for x in text.split(b"\n") if x.strip()]
    n, size = len(words), max(1, len(text))
    seen = Counter(words)
    count = np.bincount(np.frombuffer(text, dtype=np.uint8), minlength=256)
    share = [math.sqrt(count[list(chars)].sum() / size) for chars in _CLASSES]
    length = np.fromiter(map(len, words), dtype=np.float64, count=n) if n else np.zeros(1)
    return [
        math.log1p(n),
        math.log1p(n / max(1, len(lines))),
        math.log1p(length.mean()),
        math.log1p(length.std()),
        *share,
        math.log1p(len(seen)) / math.log(n + 2),
        math.sqrt(max(seen.values(), default=0) / max(1, n)),
        math.sqrt(sum(map(bytes.__eq__, words, words[1:])) / max(1, n)),
        math.sqrt(1 - len(set(lines)) / max(1, len(lines))),
        math.sqrt(len(zlib.compress(text, 1)) / size) if n else 0.0,
    ]


#: Texts that a Python worker holds at once.
_ROWS = 500


def with_statistics(docs: DataFrame, keep: list[str], name: str = "statistics") -> DataFrame:
    """``keep`` columns and an array of the text's statistics."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches(source):
            for start in range(0, whole.num_rows, _ROWS):
                batch = whole.slice(start, _ROWS)
                values = [statistics(x) for x in batch.column(len(keep)).to_pylist()]
                columns = [batch.column(i) for i in range(len(keep))]
                columns.append(pa.array(values, type=pa.list_(pa.float64())))
                yield pa.RecordBatch.from_arrays(columns, names=[*keep, name])

    narrow = docs.select(*[F.col(f"`{c}`") for c in keep], text_bytes().alias(unused(docs, "bytes")))
    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in narrow.schema[:-1])
    return narrow.mapInArrow(run, f"{kinds}`{name}` array<double>")


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document is kept from training (a null id counts as empty text)."""
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % FOLDS == 0


def _moments(rows: DataFrame) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """For each label its number of rows, mean and covariance."""
    d = len(NAMES)

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, d + 1, d + 1))
        for batch in batches(source):
            label = batch.column(0).to_numpy()
            x = np.array(batch.column(1).to_pylist())
            x = np.c_[np.ones(len(x)), x]
            for k in (0, 1):
                total[k] += x[label == k].T @ x[label == k]
        at = np.indices(total.shape).reshape(3, -1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at[0]), pa.array(at[1] * (d + 1) + at[2]), pa.array(total.ravel())],
            names=["label", "cell", "value"],
        )

    sums = rows.select("label", "statistics").mapInArrow(run, "label long, cell long, value double")
    found = np.zeros((2, (d + 1) ** 2))
    for row in sums.groupBy("label", "cell").agg(F.sum("value").alias("value")).collect():
        found[row.label, row.cell] = row.value
    out = {}
    for k, total in enumerate(found.reshape(2, d + 1, d + 1)):
        n = total[0, 0]
        mean = total[0, 1:] / max(n, 1)
        out[k] = (n, mean, total[1:, 1:] / max(n, 1) - np.outer(mean, mean))
    return out


@dataclass(frozen=True)
class Discriminant:
    means: np.ndarray  # (2, d)
    factors: np.ndarray  # (2, d, d): inverses of the Cholesky factors
    offset: float  # log prior ratio and determinants
    constant: float | None = None  # the score where a class has no rows

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        far = [(((x - m) @ f.T) ** 2).sum(axis=1) for m, f in zip(self.means, self.factors, strict=True)]
        odds = self.offset + (far[0] - far[1]) / 2
        return 1 / (1 + np.exp(-np.clip(odds, -50, 50)))


def fit(statistics_of: DataFrame, labels: DataFrame, target: str = "quality", shrinkage: float = SHRINKAGE) -> Discriminant:
    """Fit on rows (doc_id, statistics) whose doc_id is not held out."""
    known = labels.where(F.col(target).isin(0, 1)).groupBy("doc_id").agg(F.max(target).cast("long").alias("label"))
    train = statistics_of.where(~held_out()).join(known, "doc_id")
    moments = _moments(train)
    n = np.array([moments[k][0] for k in (0, 1)])
    if not n.all():
        return Discriminant(np.zeros((2, 0)), np.zeros((2, 0, 0)), 0.0, float(n[1] / n.sum()) if n.any() else 0.5)
    pooled = sum(n[k] * np.diag(moments[k][2]) for k in (0, 1)) / n.sum() + _FLOOR**2
    means, factors, offset = [], [], math.log(n[1] / n[0])
    for k in (0, 1):
        own = (1 - shrinkage) * moments[k][2] + shrinkage * np.diag(pooled)
        cholesky = np.linalg.cholesky(own)
        offset += (1 - 2 * k) * np.log(np.diag(cholesky)).sum()
        means.append(moments[k][1])
        factors.append(np.linalg.inv(cholesky))
    return Discriminant(np.array(means), np.array(factors), offset)


def with_scores(rows: DataFrame, model: Discriminant, statistics_in: str = "statistics", name: str = "score") -> DataFrame:
    """Every row and column with its score in place of the statistics."""
    keep = [c for c in rows.columns if c != statistics_in]

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(source):
            x = np.array(batch.column(len(keep)).to_pylist())
            columns = [batch.column(i) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(model.scores(x))], names=[*keep, name])

    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema if f.name != statistics_in)
    rows = rows.select(*[F.col(f"`{c}`") for c in keep], F.col(statistics_in))
    return rows.mapInArrow(run, f"{kinds}`{name}` double")


def accepted(docs: DataFrame, model: Discriminant, threshold: float = THRESHOLD) -> DataFrame:
    """The rows whose score reaches ``threshold``, in one Python stage: only they
    leave it, and a worker holds few texts at once."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches(source):
            for start in range(0, whole.num_rows, _ROWS):
                batch = whole.slice(start, _ROWS)
                texts = batch.column(at).to_pylist()
                score = model.scores(np.array([statistics((x or "").encode()) for x in texts]))
                yield batch.filter(pa.array(score >= threshold))

    at = docs.columns.index("text")
    return docs.mapInArrow(run, docs.schema)
