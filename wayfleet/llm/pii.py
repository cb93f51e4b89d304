"""Personal data: pattern matches plus spans of a character tagger.

The base finds four kinds by pattern and check.  A bidirectional LSTM with CRF
transitions, trained on windows labelled by the base, adds what looks like one
of the kinds without matching its pattern.

Windows overlap by half.  Each is decoded, spans that touch an inner edge of
their window are left to the next one, and of what remains the set of
non-overlapping spans with the largest total certainty over the whole text is
taken.  A span needs a digit or an ``@``, so only windows that hold one are
decoded; in any other no span is possible.  Spans that meet a base span or a
match that the base has ruled out are not added.

Null and empty texts have no spans.  Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfleet.llm.tagger import Tagger, characters
from wayfleet.llm.work import batches, unused

# -- fixed values --------------------------------------------------------------
KINDS = ("email", "ip", "card", "phone")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]*\Z")
# A run of digits is entered at its first digit only; matches end at the last.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

# -- parameters -----------------------------------------------------------------
WIDTH, STRIDE = 96, 48
TRAIN_DOCS, TRAIN_WINDOWS, TRAIN_STEPS = 600, 1500, 180
SURE = 0.95
#: Tags: 0 outside, 1 + 2k first character of kind k, 2 + 2k a further one.
TAGS = 1 + 2 * len(KINDS)
TRIGGER = "[0-9@]"
_TRIGGER = re.compile(TRIGGER)

Span = tuple[str, int, int]


# -- base ---------------------------------------------------------------------


def luhn(digits: str) -> bool:
    total = 0
    for i, x in enumerate(reversed(digits)):
        value = ord(x) - 48
        if i % 2:
            value = 2 * value - 9 * (value > 4)
        total += value
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches: for each @ the run of local characters before it."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            end = found.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def base_matches(text: str) -> tuple[list[Span], list[Span]]:
    """Spans that match and pass their checks, and those ruled out, each by
    kind and start."""
    kept: list[Span] = []
    ruled_out: list[Span] = []
    if "@" in text:
        kept += [("email", a, b) for a, b in _emails(text)]
    if not re.search("[0-9]", text):
        return kept, ruled_out
    for found in _IP.finditer(text):
        good = all(len(x.lstrip("0")) <= 3 and int(x[-4:]) <= 255 for x in found[0].split("."))
        (kept if good else ruled_out).append(("ip", found.start(), found.end()))
    for found in _CARD.finditer(text):
        digits = found[0].replace(" ", "").replace("-", "")
        good = 13 <= len(digits) <= 19 and luhn(digits)
        (kept if good else ruled_out).append(("card", found.start(), found.end()))
    if "+" in text:
        for found in _PHONE.finditer(text):
            digits = sum(map(str.isdigit, found[0]))
            (kept if 9 <= digits <= 15 else ruled_out).append(("phone", found.start(), found.end()))
    return kept, ruled_out


# -- windows and training --------------------------------------------------------


def windows(text: str) -> list[int]:
    """Starts of the windows of a text that hold a digit or @."""
    starts: dict[int, None] = {}
    last = max(0, -(-(len(text) - WIDTH) // STRIDE))
    for found in _TRIGGER.finditer(text):
        k = found.start() // STRIDE
        starts |= dict.fromkeys(x * STRIDE for x in (k - 1, k) if 0 <= x <= last)
    return list(starts)


def _train_windows(docs: DataFrame) -> list[tuple[str, bytes]]:
    """Window texts with their tags from the base, of a bounded sample.

    The TRAIN_DOCS documents with a digit or @ whose ids hash lowest give their
    windows, of which the TRAIN_WINDOWS with the lowest hash are taken."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(source):
            texts, tags = [], []
            for text in batch.column(0).to_pylist():
                marks = np.zeros(len(text) + WIDTH, dtype=np.uint8)
                for kind, start, end in reversed(base_matches(text)[0]):
                    marks[start:end] = 2 + 2 * KINDS.index(kind)
                    marks[start] -= 1
                for start in windows(text):
                    own = marks[start : start + WIDTH].copy()
                    if own[0] and own[0] % 2 == 0:  # cut at the left edge
                        own[0] -= 1
                    texts.append(text[start : start + WIDTH])
                    tags.append(own[: len(texts[-1])].tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(texts, pa.string()), pa.array(tags, pa.binary())], names=["text", "tags"]
            )

    # The last hash taken is looked for without the texts, which would all meet
    # in one task; rows that share it differ in nothing that matters.
    sample = docs.where(F.col("text").rlike(TRIGGER)).select("text", F.xxhash64("doc_id", "text").alias("at"))
    last = sample.select("at").orderBy("at").limit(TRAIN_DOCS).agg(F.max("at")).first()[0]
    sample = sample.where(F.col("at") <= last).select("text")
    found = sample.mapInArrow(run, "text string, tags binary").distinct()
    found = found.orderBy(F.xxhash64("text"), "tags").limit(TRAIN_WINDOWS)
    return [(row.text, bytes(row.tags)) for row in found.collect()]


def _allowed() -> np.ndarray:
    """A further character of a kind follows a character of that kind."""
    ok = np.ones((TAGS, TAGS), dtype=bool)
    for k in range(len(KINDS)):
        ok[:, 2 + 2 * k] = False
        ok[[1 + 2 * k, 2 + 2 * k], 2 + 2 * k] = True
    return ok


def fit(docs: DataFrame, steps: int = TRAIN_STEPS) -> Tagger | None:
    """A tagger trained on windows of ``docs``; None if none has a span."""
    sample = _train_windows(docs)
    if not any(any(tags) for _, tags in sample):
        return None
    ids, mask = characters([text for text, _ in sample], WIDTH)
    tags = np.zeros(ids.shape, dtype=np.int64)
    for column, (_, own) in enumerate(sample):
        tags[: len(own), column] = np.frombuffer(own, dtype=np.uint8)
    model = Tagger(TAGS, _allowed())
    model.train(ids, mask, tags, steps)
    return model


# -- decoding -----------------------------------------------------------------------


def _window_spans(tags: np.ndarray, sure: np.ndarray, start: int, size: int, whole: int) -> Iterator[tuple[str, int, int, float]]:
    """Spans of one decoded window that lie inside it."""
    t = 0
    while t < size:
        if tags[t] == 0:
            t += 1
            continue
        kind, end = (tags[t] - 1) // 2, t + 1
        while end < size and tags[end] == 2 + 2 * kind:
            end += 1
        cut = (t == 0 and start > 0) or (end == size and start + size < whole)
        if not cut:
            yield KINDS[kind], start + t, start + end, float(sure[t:end].min())
        t = end


def reconcile(spans: list[tuple[str, int, int, float]]) -> list[Span]:
    """The non-overlapping spans with the largest total certainty, over the
    whole text; earlier and shorter ones in ties."""
    best: dict[Span, float] = {}
    for kind, start, end, sure in spans:
        best[kind, start, end] = max(sure, best.get((kind, start, end), 0.0))
    ordered = sorted(best, key=lambda x: (x[2], x[1], x[0]))
    ends = [x[2] for x in ordered]
    total, taken = [0.0], [False] * len(ordered)
    before = [int(np.searchsorted(ends, x[1], side="right")) for x in ordered]
    for i, x in enumerate(ordered):
        with_it = best[x] + total[before[i]]
        taken[i] = with_it > total[i]
        total.append(max(with_it, total[i]))
    out, i = [], len(ordered)
    while i:
        if taken[i - 1]:
            out.append(ordered[i - 1])
            i = before[i - 1]
        else:
            i -= 1
    return out[::-1]


def added_spans(texts: list[str], found: list[tuple[list[Span], list[Span]]], model: Tagger, most: int = 512) -> list[list[Span]]:
    """For each text the tagger's spans that its base matches don't meet."""
    at = [(k, start) for k, text in enumerate(texts) for start in windows(text)]
    raw: list[list] = [[] for _ in texts]
    for i in range(0, len(at), most):
        own = at[i : i + most]
        cut = [texts[k][s : s + WIDTH] for k, s in own]
        tags, sure = model.decode(*characters(cut, WIDTH))
        for j in np.flatnonzero(tags.any(axis=0)):
            k, s = own[j]
            raw[k] += _window_spans(tags[:, j], sure[:, j], s, len(cut[j]), len(texts[k]))
    out = []
    for text, (kept, ruled_out), spans in zip(texts, found, raw, strict=True):
        spans = [x for x in spans if x[3] >= SURE and _TRIGGER.search(text, x[1], x[2])]
        taken = sorted((a, b) for _, a, b in (*kept, *ruled_out))
        reach = np.maximum.accumulate([b for _, b in taken]) if taken else np.empty(0)
        starts = [a for a, _ in taken]
        out.append(
            [x for x in reconcile(spans) if not ((n := int(np.searchsorted(starts, x[2]))) and reach[n - 1] > x[1])]
        )
    return out


def all_spans(texts: list[str], model: Tagger | None) -> list[tuple[list[Span], list[Span]]]:
    """(base spans, all spans) of each text, by kind as in KINDS, then start."""
    found = [base_matches(x) for x in texts]
    more = added_spans(texts, found, model) if model else [[] for _ in texts]
    order = lambda x: (KINDS.index(x[0]), x[1], x[2])
    return [(kept, sorted([*kept, *extra], key=order)) for (kept, _), extra in zip(found, more, strict=True)]


def _groups(batch: pa.RecordBatch, column: int, characters_at_once: int = 2_000_000) -> Iterator[tuple[int, list[str]]]:
    """Consecutive texts of a batch, a bounded amount of text at a time."""
    start, held, size = 0, [], 0
    for i, text in enumerate(batch.column(column).to_pylist()):
        held.append(text)
        size += len(text)
        if size > characters_at_once:
            yield start, held
            start, held, size = i + 1, [], 0
    if held:
        yield start, held


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def with_spans(docs: DataFrame, model: Tagger | None, keep: list[str]) -> DataFrame:
    """``keep`` columns, with ``base`` and ``spans``: arrays of (kind, start,
    end).  Texts without a digit or @ stay in the JVM: they have no spans."""
    size = len(keep)

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(spans: list[Span]) -> list[dict]:
            return [{"kind": k, "start": a, "end": b} for k, a, b in spans]

        for batch in batches(source):
            for start, texts in _groups(batch, size):
                found = all_spans([x or "" for x in texts], model)
                part = batch.slice(start, len(texts))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(i) for i in range(size)), *(pa.array([rows(x[i]) for x in found], _SPANS) for i in (0, 1))],
                    names=[*keep, "base", "spans"],
                )

    text = F.when(F.col("text").rlike(TRIGGER), F.col("text")).otherwise("")
    narrow = docs.select(*[F.col(f"`{c}`") for c in keep], text.alias("__text"))
    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in narrow.schema[:-1])
    span = "array<struct<kind:string,start:int,end:int>>"
    return narrow.mapInArrow(run, f"{kinds}base {span}, spans {span}")


def redacted(docs: DataFrame, model: Tagger | None) -> DataFrame:
    """``docs`` with each span of a text replaced by its kind in brackets;
    ``n_chars``, if there, follows.  Of overlapping spans the one that begins
    first, then the longest, names the replacement, which covers them all."""
    columns, kinds = docs.columns, docs.schema
    at = columns.index("text")

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(source):
            for start, texts in _groups(batch, len(columns)):
                part = batch.slice(start, len(texts))
                whole = part.column(at).to_pylist()
                found = all_spans([x or "" for x in texts], model)
                clean = [replaced(t, spans) if spans else t for t, (_, spans) in zip(whole, found, strict=True)]
                out = [part.column(i) for i in range(len(columns))]
                out[at] = pa.array(clean, out[at].type)
                yield pa.RecordBatch.from_arrays(out, names=columns)

    text = F.when(F.col("text").rlike(TRIGGER), F.col("text")).otherwise("")
    narrow = docs.select(*[F.col(f"`{c}`") for c in columns], text.alias(unused(docs, "trigger")))
    made = narrow.mapInArrow(run, kinds)
    if "n_chars" in columns:
        kind = docs.schema["n_chars"].dataType
        made = made.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars")))
    return made


def replaced(text: str, spans: list[Span]) -> str:
    out, end = [], 0
    for kind, start, stop in sorted(spans, key=lambda x: (x[1], -x[2])):
        if start >= end:
            out += [text[end:start], f"[{kind.upper()}]"]
        end = max(end, stop)
    return "".join([*out, text[end:]])
