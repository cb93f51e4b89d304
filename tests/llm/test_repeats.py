from __future__ import annotations

import random

import numpy as np
import pytest

from tests.llm.helpers import ODD, frame
from wayfleet.llm import repeats


def expected(texts, length):
    seen = {}
    for t in texts:
        for i in range(len(t) - length + 1):
            seen[t[i : i + length]] = seen.get(t[i : i + length], 0) + 1
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 1, dtype=np.int8)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = 1
        kept = bytes(np.frombuffer(t, np.uint8)[gone[:-1] == 0])
        out.append((len(t), int(gone.sum()), int((np.diff(np.r_[0, gone]) == 1).sum()), kept))
    return out


def texts(seed):
    rng = random.Random(seed)
    make = lambda n, k: "".join(rng.choice("abcdefghé \n"[:k]) for _ in range(n))
    passages = [make(rng.randrange(15, 60), 11) for _ in range(6)]
    out = [make(rng.randrange(0, 60), 11) + "".join(rng.choice(passages) + make(rng.randrange(0, 9), 11) for _ in range(rng.randrange(4))) for _ in range(80)]
    return [*out, out[3], out[3], make(400, 2), make(90, 1), "ab" * 60, passages[0][:19]]


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(spark, seed):
    rows = [*texts(seed), None, ""]
    found = repeats.without_repeats(frame(spark, rows), 20, 10).orderBy("doc_id").collect()
    want = expected([(t or "").encode() for t in rows], 20)
    assert [(r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in found] == want


def test_production_lengths_with_odd_texts(spark):
    rng = random.Random(5)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(450))
    rows = [*ODD, passage, "x " + passage[100:] + " y", passage[:199], passage[50:250] + "q", (None, "x"), (1, "again" * 60), (1, "again" * 60)]
    found = repeats.without_repeats(frame(spark, rows)).collect()
    plain = [(x[1] if isinstance(x, tuple) else x) or "" for x in rows]
    want = expected([t.encode() for t in plain], 200)
    assert sorted((r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in found) == sorted(want)


def test_pieces_give_the_same_windows(monkeypatch):
    text = bytes(random.Random(1).choices(range(97, 101), k=5000))
    whole = repeats.sampled(next(repeats._pieces([text], 200)), 200, 100)
    assert (whole["low"][1:] == whole["high"][:-1] + 1).all() and whole["high"][-1] == 4800
    monkeypatch.setattr(repeats, "PIECE", 700)
    pieces = [repeats.sampled(p, 200, 100) for p in repeats._pieces([text], 200)]
    low, high = (np.concatenate([p[x] for p in pieces]) for x in ("low", "high"))
    assert (low[1:] == high[:-1] + 1).all() and high[-1] == 4800
    at = {int(w): int(a) for p in (whole,) for a, lo, hi in zip(p["at"], p["low"], p["high"], strict=True) for w in range(lo, hi + 1)}
    assert all(at[w] == a for p in pieces for a, lo, hi in zip(p["at"], p["low"], p["high"], strict=True) for w in range(lo, hi + 1))


def test_empty_table(spark):
    assert repeats.without_repeats(frame(spark, [])).count() == 0
