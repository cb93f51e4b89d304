from __future__ import annotations

import math

import numpy as np
import pytest

from wayfleet.llm import mtree, vectors

ROWS = "vec_id long, embedding array<float>, label int, v int, ids string, pivot int, query int, score int"


def table(spark, rows):
    return spark.createDataFrame([(i, e, 0, 1, "x", 2, 3, 4) for i, e in rows], ROWS)


def expected(rows, k=5, every=50):
    whole = sorted({
        (i, tuple(math.floor(256 * float(np.float32(x))) for x in e))
        for i, e in rows
        if i is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)
    })
    out = []
    for q, a in whole:
        if q % every == 0:
            found = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in whole if i != q)[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(found)]
    return sorted(out)


def result(frame):
    return sorted(tuple(r) for r in frame.collect())


def clustered(seed, n, width=8):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, width))
    return [(i, [float(x) for x in centres[i % 6] + 0.2 * rng.normal(size=width)]) for i in range(n)]


def test_equals_brute_force_with_ties_copies_and_odd_rows(spark):
    rows = clustered(1, 400)
    rows += [(400 + i, rows[7][1]) for i in range(120)]  # copies, queries among them
    rows += [(600, [0.0] * 8), (601, None), (602, [1.0, None]), (603, [float("nan")] * 8), (None, [9.0] * 8)]
    rows += [(650, [0.5, 0.25]), (651, []), rows[50], rows[50], (700, rows[3][1]), (700, rows[4][1])]
    found = mtree.top_of_table(table(spark, rows))
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    assert result(found) == expected(rows)


def test_many_small_pages_and_passes(spark, monkeypatch):
    monkeypatch.setattr(mtree, "PAIRS", 100)
    monkeypatch.setattr(mtree, "PAIRS_PER_VECTOR", 0.1)
    rows = clustered(2, 900)
    own = vectors.integer_vectors(table(spark, rows), 256, ["vec_id"])
    found = mtree.top_k(own, own.where("vec_id % 50 = 0"), 5, page=40, node=5, pivots=16)
    assert result(found) == expected(rows)


def test_fewer_rows_than_asked_for_and_none(spark):
    rows = [(0, [1.0, 2.0]), (1, [0.5, 0.5]), (50, [-1.0, 0.0])]
    assert result(mtree.top_of_table(table(spark, rows))) == expected(rows)
    assert result(mtree.top_of_table(table(spark, []))) == []
    assert result(mtree.top_of_table(table(spark, [(1, [1.0])]))) == []
    assert result(mtree.top_of_table(table(spark, [(0, [1.0])]))) == []


def test_bounds_spare_most_of_the_distances():
    rng = np.random.default_rng(3)
    centres = 200 * rng.normal(size=(20, 16))
    points = np.floor(np.concatenate([c + 10 * rng.normal(size=(50, 16)) for c in centres]))
    raw = [x.astype("<i4").tobytes() for x in points]
    space = mtree.Space(16, float((points**2).sum(axis=1).max()))
    full = space.points(raw)
    away = mtree.distances(full, full[::50])
    node, near = away.argmin(axis=1), away.min(axis=1)
    order = np.lexsort((near, node))
    up = mtree.distances(full, full[:1])[:, 0]
    page = mtree.Page(space, node[order], near[order], up[order], [raw[i] for i in order], [[int(i)] for i in order])
    looked = []

    class Counting(np.ndarray):
        def __getitem__(self, key):
            if isinstance(key, np.ndarray):
                looked.append(len(key))
            return np.asarray(super().__getitem__(key))

    page.points = page.points.view(Counting)
    for i in range(0, 1000, 100):
        q = space.queries([raw[i]])[0]
        best = page.search(q, mtree.distances(q[None], full[:1])[0, 0], -math.inf, 5)
        score = points @ points[i]
        assert best == sorted((-int(s), j) for j, s in enumerate(score))[:5]
    assert sum(looked) < 0.5 * 10 * len(points)


def test_too_large_components_are_an_error(spark):
    with pytest.raises(Exception, match="lies beyond"):
        mtree.top_of_table(table(spark, [(0, [1e9]), (1, [1.0])])).collect()
