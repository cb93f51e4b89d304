from __future__ import annotations

import random
from collections import defaultdict

from tests.llm.helpers import ODD, frame, words
from wayfleet.llm import packing


def plain(rows, capacity, per_source):
    """Best fit that looks at every open bin."""
    out, rest, bins = [], [], []
    for number, size, source, cluster in rows:
        for piece in range(size // capacity):
            bins.append([0, [], []])
            out.append((number, piece, len(bins) - 1, 0, capacity))
        if size % capacity:
            rest.append((size % capacity, number, size // capacity, source, cluster))
    for size, number, piece, source, cluster in sorted(rest, key=lambda x: (-x[0], x[1])):
        fits = [
            (room, k) for k, (room, sources, clusters) in enumerate(bins)
            if room >= size and sources.count(source) < per_source and cluster not in clusters
        ]
        if fits:
            k = min(fits)[1]
        else:
            bins.append([capacity, [], []])
            k = len(bins) - 1
        out.append((number, piece, k, capacity - bins[k][0], size))
        bins[k][0] -= size
        bins[k][1].append(source)
        bins[k][2].append(cluster)
    return out


def test_equals_a_plain_best_fit():
    for seed in range(150):
        rng = random.Random(seed)
        rows = [(k, rng.randrange(1, 50), rng.choice("aaab"), rng.randrange(12)) for k in range(rng.randrange(80))]
        limit = rng.choice((1, 2, 4))
        assert packing.pack_lane(rows, 20, limit) == plain(rows, 20, limit)


def test_words_are_counted(spark):
    rows = [*ODD, "a b  c\n\td \x0b\x0ce\r", " lead"]
    found = packing.packed(frame(spark, rows), 10**6).collect()
    assert {r.doc_id: r["size"] for r in found} == {k: len((t or "").encode().split()) + 1 for k, t in enumerate(rows)}


def test_bins_keep_every_constraint(spark):
    rng = random.Random(4)
    texts = [" ".join(words(k % 90, rng.randrange(1, 120))) for k in range(300)] + ["same text"] * 60 + ODD
    docs = frame(spark, [*texts, (None, "x"), (2, "again"), (2, "again")])
    found = packing.packed(docs, 100, 2, 100).collect()
    bins = defaultdict(list)
    for r in found:
        bins[r.lane, r.bin].append(r)
    for own in bins.values():
        own.sort(key=lambda r: r.offset)
        assert all(a.offset + a["size"] == b.offset for a, b in zip(own, own[1:], strict=False))
        assert own[0].offset == 0 and own[-1].offset + own[-1]["size"] <= 100
        assert sum(300 <= (r.doc_id or 0) < 360 for r in own) <= 1
    total = sum(len((t or "").split(" ")) for t in texts)
    assert len(found) >= len(texts) + 3 and sum(r["size"] for r in found) > total / 2


def test_empty_table(spark):
    assert packing.packed(frame(spark, [])).count() == 0


def test_equal_rows_are_spread_over_lanes(spark):
    """All of one text, one id and one source: lanes stay even and bins keep copies apart."""
    rows = spark.range(12_000).selectExpr("CAST(NULL AS LONG) AS doc_id", "'same words' AS text", "'s' AS source")
    found = packing.packed(rows).groupBy("lane").agg({"*": "count", "bin": "max"}).collect()
    assert len(found) == 4 and all(abs(r["count(1)"] - 3000) < 300 for r in found)
    assert all(r["max(bin)"] + 1 == r["count(1)"] for r in found)
