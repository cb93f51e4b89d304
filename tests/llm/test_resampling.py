from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np

from tests.llm.helpers import ODD, frame, words
from wayfleet.llm import resampling


def own_words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def own_buckets(text):
    w = own_words(text)
    runs = [" ".join(w[i : i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)]
    return [zlib.crc32(r.encode()) % 10000 for r in runs]


def expected(docs, target):
    s, t = Counter(), Counter()
    for _, x in docs:
        s.update(own_buckets(x))
    for x in target:
        t.update(own_buckets(x))
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (big_s + 10000) / ((s[b] + 1) * (big_t + 10000))))
    out = []
    for i, x in docs:
        found = own_buckets(x)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(map(gain, found))
        out.append([i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    able = [r for r, (_, x) in zip(out, docs) if len(own_words(x)) >= 20]
    able.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for r in out:
        r.append(None)
    for n, r in enumerate(able[: 5 * len(able) // 100]):
        r[4] = n + 1
    return sorted(map(tuple, out), key=str)


def run(spark, docs, target):
    items = spark.createDataFrame([(k, x) for k, x in enumerate(target)], "item_id long, text string")
    found = resampling.resampled(frame(spark, docs), items)
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    return sorted((tuple(r) for r in found.collect()), key=str)


def test_equals_plain_counts(spark):
    texts = [*ODD, "A-Z_a z9 Ünder_STRICH x\x00y é9É", "one two", "one", *(" ".join(words(k, 15 + k % 40, 60)) for k in range(300))]
    docs = [*enumerate(texts), (None, " ".join(words(1, 30))), (5, " ".join(words(2, 30)))]
    target = [None, "", *(" ".join(words(k, 25, 60)) for k in range(50, 70))]
    assert run(spark, docs, target) == expected(docs, target)


def test_repeated_rows_and_empty_tables(spark):
    docs = [(1, " ".join(words(3, 40)))] * 60
    found = run(spark, docs, [])
    assert sorted(r[4] for r in found if r[4]) == [1, 2, 3]
    assert {r[:4] for r in found} == {r[:4] for r in expected(docs, [])}
    assert run(spark, [], ["a b c"]) == []


def test_spans_and_packing():
    clean = resampling.words_only("  The  cat, sat ".encode())
    assert [clean[a:b] for a, b in resampling.spans(clean)] == [
        b"the", b"cat", b"sat", b"the cat", b"cat sat", b"the cat sat"
    ]
    for found in ([], [0], [9999], [0, 0, 3, 700, 9999, 9999]):
        own = np.array(found, dtype=np.uint32)
        assert resampling.unpacked(resampling.packed(own)).tolist() == found
