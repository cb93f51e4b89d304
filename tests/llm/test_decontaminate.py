from __future__ import annotations

import random

from tests.llm.helpers import ODD, frame, words
from wayfleet.llm import decontaminate

ITEM = (
    "A train with 5 cars leaves Paris at 9 with 40 kg of coal and returns to Paris later "
    "with 5 more cars than it had before it left the town"
)
AGAIN = (
    "A train with 7 cars leaves London at 3 with 60 kg of coal and returns to London later "
    "with 7 more cars than it had before it left the town"
)


def items(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")


def found(spark, docs, *texts):
    rows = decontaminate.contaminated(frame(spark, docs), items(spark, *texts)).collect()
    return {(r.doc_id, r.item_id): r for r in rows}


def test_other_values_are_caught_if_consistent(spark):
    wrong = AGAIN.replace("to London", "to Rome").replace("with 7 more", "with 8 more")
    docs = [f"Before it. {AGAIN} and after", wrong, ITEM.upper().replace("KG", "kg").replace("PARIS", "Paris"), "A short ITEM here", "short item", *ODD, AGAIN]
    got = found(spark, docs, ITEM, "a short item here!", None, "")
    assert set(got) == {(0, 0), (2, 0), (3, 1), (13, 0)}
    assert got[0, 0].n_changed > 0 and got[0, 0].n_matched == got[0, 0].n_windows


def test_copies_in_other_case_or_spacing_are_caught(spark):
    german = "Der Hund und die Katze sehen im Garten den Vogel auf dem Baum neben dem Haus der Familie am Rand der Stadt"
    docs = [german.lower(), german.upper(), german.replace(" ", "\n"), german.replace(" ", "  "), german.lower().replace("hund", "esel"), german[:40]]
    got = found(spark, docs, german)
    assert set(got) == {(k, 0) for k in range(5)}
    assert all(got[k, 0].n_matched == got[k, 0].n_windows for k in range(4))


def test_an_inconsistent_value_voids_its_own_windows_only(spark):
    rest = " ".join(words(6, 40))
    got = found(spark, [f"so 7 old cars and 8 more cars {rest}"], f"so 5 old cars and 5 more cars {rest}")
    assert set(got) == {(0, 0)} and got[0, 0].n_matched == got[0, 0].n_windows - 6


def test_half_of_an_item_is_enough_less_is_not(spark):
    own = words(1, 40)
    some = [" ".join(own), " ".join([*words(2, 30), *own[:26], *words(3, 30)]), " ".join([*words(4, 30), *own[:20], *words(5, 9)])]
    assert set(found(spark, some, " ".join(own))) == {(0, 0), (1, 0)}


def test_windows_equal_a_plain_version(spark):
    bench = [" ".join(words(100 + k, 12 + k)) for k in range(8)]
    docs = [" ".join([*words(k, 30, 50), *bench[k % 8].split()[: 4 + k], *words(50 + k, 20, 50)]) for k in range(24)]
    want = set()
    for i, doc in enumerate(docs):
        have = {tuple(doc.split()[p : p + 8]) for p in range(len(doc.split()) - 7)}
        for j, item in enumerate(bench):
            own = {tuple(item.split()[p : p + 8]) for p in range(len(item.split()) - 7)}
            if 2 * len(own & have) >= len(own):
                want.add((i, j))
    assert set(found(spark, docs, *bench)) == want and want


def test_empty_tables(spark):
    assert found(spark, [], ITEM) == {}
    assert found(spark, [ITEM]) == {}
    assert decontaminate.without_contaminated(frame(spark, [ITEM, "x", None]), items(spark, ITEM)).count() == 2


def test_documents_without_an_id_are_found_by_their_texts(spark):
    got = decontaminate.contaminated(frame(spark, [(None, ITEM), (None, ITEM), (None, AGAIN), (4, "x"), (4, ITEM)]), items(spark, ITEM))
    assert sorted(((r.doc_id, r.n_changed > 0) for r in got.collect()), key=str) == [(4, False), (None, False), (None, True)]
    docs = frame(spark, [(None, ITEM), (4, "x"), (4, ITEM), (None, "y")])
    assert sorted(r.text for r in decontaminate.without_contaminated(docs, items(spark, ITEM)).collect()) == ["x", "y"]


def _plain_verdict(doc, item, size=8):
    """Brute force over alignments, for texts whose marked words are given as
    (mark, value) pairs: matched windows of the item."""
    mark = lambda w: w[0] if isinstance(w, tuple) else w
    value = lambda w: w[1] if isinstance(w, tuple) else w
    windows = {}
    for i in range(len(item) - size + 1):
        windows.setdefault(tuple(map(mark, item[i : i + size])), []).append(i)
    matched = set()
    for d in range(-len(item) + 1, len(doc)):
        hits = [i for i in range(len(item) - size + 1) if 0 <= i + d <= len(doc) - size]
        plain = lambda i: all(value(x) == value(y) for x, y in zip(item[i : i + size], doc[i + d : i + d + size]))
        typed = lambda i: all(mark(x) == mark(y) for x, y in zip(item[i : i + size], doc[i + d : i + d + size]))
        hits = [i for i in hits if plain(i) or typed(i)]
        slots = {}
        for i in hits:
            for x, y in zip(item[i : i + size], doc[i + d : i + d + size]):
                if isinstance(x, tuple):
                    slots.setdefault(x, set()).add(value(y))
        for i in hits:
            if plain(i) or all(len(slots[x]) == 1 for x in item[i : i + size] if isinstance(x, tuple)):
                matched.add(tuple(map(mark, item[i : i + size])))
    return len(matched), len(windows)


def test_templates_slots_and_consistency_equal_brute_force(spark):
    rng = random.Random(5)

    def text(seed, values):
        own, out = random.Random(seed), []
        for w in words(seed, 26):
            if own.random() < 0.25:
                slot = own.randrange(3)
                out.append(("#", str(values[slot])))
            out.append(w)
        return out

    show = lambda ws: "so " + " ".join(w[1] if isinstance(w, tuple) else w for w in ws)
    bench = [text(k, [11, 22, 33]) for k in range(6)]
    docs = []
    for k in range(36):
        again = text(k % 6, rng.choice([[11, 22, 33], [44, 55, 66], [44, 44, 66]]))
        at = [i for i, w in enumerate(again) if isinstance(w, tuple)]
        for i in rng.sample(at, min(len(at), rng.choice([0, 0, 1, 2]))):
            again[i] = ("#", str(rng.randrange(70, 99)))  # an inconsistent value
        docs.append([*words(200 + k, 5), *again[rng.choice([0, 0, 4, 9]) :], *words(300 + k, 5)])
    want = {}
    for i, doc in enumerate(docs):
        for j, item in enumerate(bench):
            n, of = _plain_verdict(["so", *doc], ["so", *item])
            if 2 * n >= of:
                want[i, j] = (n, of)
    got = found(spark, [show(x) for x in docs], *map(show, bench))
    assert {k: (r.n_matched, r.n_windows) for k, r in got.items()} == want and 5 < len(want) < 36
