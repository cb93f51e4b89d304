from __future__ import annotations

import pytest

import corpus_pipeline
from tests.llm.helpers import ODD, frame, words
from wayfleet.llm import queries

ITEM = " ".join(words(77, 30))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("tables"))
    good = [" ".join(words(k, 150, 10**6)) + "." for k in range(100)]
    junk = [" ".join(w + "###" for w in words(500 + k, 100, 20)) for k in range(60)]
    texts = [*good, *junk, good[5], good[6] + " more", good[7] + " " + ITEM, "mail u1@mail.example.com " + " ".join(words(888, 150, 10**6))]
    frame(spark, [*texts, (None, " ".join(words(999, 150, 10**6)))], clashing=False).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(0, ITEM)], "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    spark.createDataFrame([(k, int(k < 100), 0) for k in range(160)], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    return at


def test_each_stage_decides(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    after = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == columns
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        after[name] = {r.doc_id: r.text for r in docs.collect()}
    assert len(set(range(100)) & set(after["quality"])) >= 99 and not set(range(100, 160)) & set(after["quality"])
    near = after["near_duplicates"]
    assert {5, 6, 7, None} <= set(near) and not {160, 161} & set(near)
    assert 162 not in after["benchmark_leaks"] and len(after["benchmark_leaks"]) >= len(near) - 1
    assert after["personal_data"][163].startswith("mail [EMAIL] ")
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
    assert {r.doc_id for r in packed} == set(after["personal_data"])


def test_run_and_registration(spark, folder):
    assert corpus_pipeline.run(spark, folder).count() > 90
    assert [*range(1, 14)] == sorted(int(k[2:].split("_")[0]) for k in queries.queries())


def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


def tables(spark, at, items=(), labels=()):
    spark.createDataFrame([*items], "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    spark.createDataFrame([*labels], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    return str(at)


def test_rows_are_told_apart_whatever_their_ids(spark, tmp_path):
    at = tables(spark, tmp_path, [(0, ITEM)])
    a, b, c = (" ".join(words(k, 60, 10**6)) for k in (1, 2, 3))
    docs = frame(spark, [(3, a), (7, a), (7, b), (7, b), (None, c), (None, c), (9, c), (None, "x " + ITEM), (7, ITEM)])
    near = stage("near_duplicates")(spark, docs, at)
    assert near.columns == docs.columns
    got = [(r.doc_id, r.text) for r in near.collect()]
    assert sorted(got, key=str) == sorted([(3, a), (7, b), (9, c), (None, "x " + ITEM), (7, ITEM)], key=str)
    clean = stage("benchmark_leaks")(spark, docs, at)
    assert clean.columns == docs.columns
    assert sorted((r.text for r in clean.collect())) == sorted([a, a, b, b, c, c, c])


def test_stages_take_clashing_columns_odd_texts_and_empty_tables(spark, tmp_path):
    at = tables(spark, tmp_path)
    names = ("row", "ROW_", "statistics", "score", "doc_key", "__text", "doc", "group", "first")
    docs = frame(spark, [*ODD, "one two"], clashing=False).selectExpr("*", *[f"doc_id AS {c}" for c in names])
    none = docs.where("doc_id < 0")
    for name, run in corpus_pipeline.STAGES[:-1]:
        got = run(spark, docs, at)
        assert got.columns == docs.columns, name
        texts = {r.text for r in got.collect()}
        assert "one two" in texts and len(texts) >= 5, name
        assert run(spark, none, at).collect() == [], name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, at).count() >= docs.count()
    assert corpus_pipeline.STAGES[-1][1](spark, none, at).collect() == []
