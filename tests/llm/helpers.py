"""Small documents for the tests of the corpus operators."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"

#: Columns whose names clash with what operators use inside.
CLASHING = ("key", "node", "row", "shard", "lane", "size", "score", "statistics", "spans", "hash", "pos", "line", "f0")


def frame(spark, texts, first=0, source="s", clashing=True):
    """Documents with ids from ``first`` on; a (id, text) pair sets its own id."""
    rows = []
    for i, x in enumerate(texts):
        doc_id, text = x if isinstance(x, tuple) else (first + i, x)
        rows.append((doc_id, text, "en", f"{source}{i % 3}", len(text or "")))
    out = spark.createDataFrame(rows, DOCS)
    if clashing:
        out = out.selectExpr("*", *[f"doc_id AS {c}" for c in CLASHING])
    return out


def words(seed, n, vocabulary=4000):
    """Words of letters only."""
    rng = random.Random(seed)
    return ["w" + "".join(chr(97 + int(c)) for c in str(rng.randrange(vocabulary))) for _ in range(n)]


def edited(text, seed, edits):
    rng, own = random.Random(seed), text.split()
    for _ in range(edits):
        own[rng.randrange(len(own))] = f"x{rng.randrange(10**6)}"
    return " ".join(own)


#: Null, empty, blank, repeated, non-ASCII and very long texts.
ODD = [None, "", " \n\t ", "one", "one", "ÄÖ ß x \U0001f600 é", "a" * 30_000, "word " * 9_000]
