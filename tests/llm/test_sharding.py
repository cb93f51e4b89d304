from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np

from tests.llm.helpers import ODD, frame
from wayfleet.llm import sharding


def test_shards_differ_by_one_and_keep_copies_together(spark):
    texts = [f"text {k}" for k in range(130)] + [f"copy {k // 3}" for k in range(60)] + ["hot"] * 70 + ODD
    docs = frame(spark, [*texts, (None, "x"), (3, "again"), (3, "again")])
    rows = sharding.sharded(docs, 7).collect()
    sizes = Counter(r.shard for r in rows)
    assert len(rows) == len(texts) + 3 and set(sizes) == set(range(7))
    assert max(sizes.values()) - min(sizes.values()) <= 1
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    by_id = {r.doc_id: r for r in rows}
    for k in (0, 131, 200):
        raw = texts[k].encode()
        assert (by_id[k]["size"], by_id[k].text_crc32) == (len(raw) + 16, zlib.crc32(raw))
    null = by_id[len(texts) - len(ODD)]
    assert (null["size"], null.text_crc32, null.law, null.grown_shard) == (16, 0, "rows", None)
    together = [len({by_id[130 + 3 * g + i].shard for i in range(3)}) for g in range(20)]
    assert sum(n == 1 for n in together) >= 15
    hot = Counter(by_id[k].shard for k in range(190, 260))
    assert sum(n for _, n in hot.most_common(4)) >= 60


def test_quotas_keep_the_limit():
    rng = np.random.default_rng(0)
    for _ in range(200):
        wishes = rng.integers(0, 20, (6, 6))
        np.fill_diagonal(wishes, 0)
        sizes = wishes.sum(axis=1) + rng.integers(0, 10, 6)
        most = int(sizes.mean() * 1.1) + 1
        allowed = sharding.quotas(wishes, sizes, most)
        after = sizes - allowed.sum(axis=1) + allowed.sum(axis=0)
        assert (allowed <= wishes).all() and (after <= np.maximum(sizes, most)).all()


def test_few_and_no_rows(spark):
    assert {r.slot for r in sharding.sharded(frame(spark, ["a", "a", None]), 40).collect()} == {0}
    assert sharding.sharded(frame(spark, []), 40).count() == 0
