from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from tests.llm.helpers import ODD, frame, words
from wayfleet.llm import discriminant


def sample(spark):
    rng = random.Random(0)
    good = [" ".join(words(k, rng.randrange(60, 300))) + ".\n" for k in range(150)]
    bad = [" ".join(w + "###" for w in words(900 + k, rng.randrange(60, 300), 30)) for k in range(150)]
    docs = frame(spark, [*good, *bad, *ODD, (None, "x"), (4, good[4])])
    rows = [(k, int(k < 150)) for k in range(300)] + [(7, 0), (8, None), (99_999, 1), (None, 1)]
    return docs, spark.createDataFrame(rows, "doc_id long, quality int")


def scores(docs, labels):
    rows = discriminant.with_statistics(docs, ["doc_id"])
    model = discriminant.fit(rows, labels)
    return model, discriminant.with_scores(rows, model).withColumn("held_out", discriminant.held_out()).collect()


def test_held_out_documents_are_told_apart(spark):
    docs, labels = sample(spark)
    _, rows = scores(docs, labels)
    assert len(rows) == 300 + len(ODD) + 2 and all(0 <= r.score <= 1 for r in rows)
    known = [r for r in rows if r.held_out and r.doc_id is not None and r.doc_id < 300]
    assert known and all((r.score >= 0.3) == (r.doc_id < 150) for r in known)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows if r.doc_id is not None)


def test_scores_are_density_differences(spark):
    docs, labels = sample(spark)
    model, _ = scores(docs, labels)
    texts = {k: (t or "").encode() for k, t in ((r.doc_id, r.text) for r in docs.collect() if r.doc_id is not None)}
    label = {k: int(k < 150) for k in range(300)}
    train = [k for k in label if zlib.crc32(str(k).encode()) % 5]
    x = {c: np.array([discriminant.statistics(texts[k]) for k in train if label[k] == c]) for c in (0, 1)}
    n = {c: len(v) for c, v in x.items()}
    pooled = sum(n[c] * x[c].var(axis=0) for c in (0, 1)) / sum(n.values()) + 1e-6
    q = np.array([discriminant.statistics(texts[k]) for k in range(0, 300, 7)])
    log = {}
    for c in (0, 1):
        own = 0.85 * np.cov(x[c].T, bias=True) + 0.15 * np.diag(pooled)
        d = q - x[c].mean(axis=0)
        log[c] = np.log(n[c]) - np.linalg.slogdet(own)[1] / 2 - np.einsum("ij,ij->i", d @ np.linalg.inv(own), d) / 2
    want = 1 / (1 + np.exp(-np.clip(log[1] - log[0], -50, 50)))
    assert np.allclose(model.scores(q), want, atol=1e-5)


@pytest.mark.parametrize(("rows", "want"), [([], 0.5), ([(k, 1) for k in range(30)], 1.0), ([(k, 0) for k in range(30)], 0.0)])
def test_without_a_class_scores_are_the_share(spark, rows, want):
    docs, _ = sample(spark)
    _, got = scores(docs, spark.createDataFrame(rows, "doc_id long, quality int"))
    assert {r.score for r in got} == {want}


def test_empty_table(spark):
    _, labels = sample(spark)
    assert scores(frame(spark, []), labels)[1] == []


def test_accepted_rows_are_those_with_enough_score(spark):
    docs, labels = sample(spark)
    model, _ = scores(docs, labels)
    rows = discriminant.with_scores(discriminant.with_statistics(docs, ["doc_id", "text"]), model)
    want = [(r.doc_id, r.text) for r in rows.where("score >= 0.3").collect()]
    kept = discriminant.accepted(docs, model)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(want, key=str) and want
