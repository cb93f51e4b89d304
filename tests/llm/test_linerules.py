from __future__ import annotations

from collections import Counter

from tests.llm.helpers import ODD, frame, words
from wayfleet.llm import linerules


def plain_repeats(own):
    count = Counter(tuple(own[i : i + 3]) for i in range(len(own) - 2))
    return len({i + k for i in range(len(own) - 2) if count[tuple(own[i : i + 3])] > 1 for k in range(3)})


def test_repeated_words_equal_a_plain_count():
    for seed in range(200):
        own = [w.encode() for w in words(seed, seed, 2 + seed % 7)]
        assert linerules.repeated_words(own) == plain_repeats(own)


def test_statistics_of_a_text():
    text = "Aé b#\n\nb#\nAé b#\n \tx|y"
    assert linerules.base_statistics(text.encode()) == (6, 13, 4, 1, 0)
    assert linerules.base_statistics(b"") == (0, 0, 0, 0, 0)
    assert linerules.base_statistics("a b\x1cc d".encode()) == (2, 6, 0, 0, 0)


def test_common_lines_of_a_host_deplete_documents(spark):
    line = " ".join(words(1, 60))
    own = [" ".join(words(10 + k, 80)) for k in range(40)]
    texts = [f"{own[k]}\n{line.upper()} " if k % 2 else f"{line}\n{own[k].split()[0]}" for k in range(40)]
    rows = [*texts, *own, *ODD, (None, own[0]), (3, own[1])]
    docs = frame(spark, rows).drop("source").selectExpr("*", "IF(doc_id < 40, 'a', NULL) AS source")
    got = {r.doc_id: r for r in linerules.judged(docs, most_docs=20).collect() if r.doc_id not in (None, 3)}
    for k in range(4, 40):
        assert got[k].n_removed_words == 60 and got[k].kept == bool(k % 2)
    assert all(got[40 + k].kept and got[40 + k].n_removed_words == 0 for k in range(40))
    odd = [got[80 + k] for k in range(len(ODD))]
    assert all(r.base_failed and not r.kept for r in odd)


def test_few_lines_are_left_alone(spark):
    rows = [" ".join(words(k, 60)) for k in range(30)] + [" ".join(words(99, 60))] * 20
    assert all(r.kept for r in linerules.judged(frame(spark, rows)).collect())
    assert linerules.judged(frame(spark, [])).count() == 0


def test_a_page_copied_in_a_large_host_is_removed(spark):
    """The verdict comes from the copies, not from their share of the host."""
    page = "\n".join(" ".join(words(7000 + k, 20)) for k in range(4))
    own = spark.range(20_000).selectExpr("id AS doc_id", "concat_ws(' ', transform(sequence(1, 60), i -> translate(id * 61 + i, '0123456789', 'abcdefghij'))) AS text")
    pages = spark.range(20_000, 20_900).selectExpr("id AS doc_id", f"'{page}' AS text")
    small = spark.range(30_000, 30_021).selectExpr("id AS doc_id", f"'{page}' AS text")
    docs = own.unionByName(pages).selectExpr("*", "'large' AS source").unionByName(small.selectExpr("*", "'small' AS source"))
    found = linerules.judged(docs).groupBy("base_failed", "kept", "n_removed_words").count().collect()
    assert {(r.base_failed, r.kept, r.n_removed_words): r["count"] for r in found} == {
        (False, True, 0): 20_000, (False, False, 80): 921,
    }


def test_short_lines_have_a_higher_limit(spark):
    heading = "Part One"
    docs = frame(spark, [f"{heading}\n" + " ".join(words(k, 60)) for k in range(60)])
    docs = docs.drop("source").selectExpr("*", "'a' AS source")
    assert {r.n_removed_words for r in linerules.judged(docs, most_docs_short=59).collect()} == {2}
    assert {r.n_removed_words for r in linerules.judged(docs).collect()} == {0}
