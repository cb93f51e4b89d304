from __future__ import annotations

import random
import re

import numpy as np

from tests.llm.helpers import ODD, frame
from wayfleet.llm import pii
from wayfleet.llm.tagger import Tagger, characters

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_base(text):
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in CARD.finditer(text):
        d = [int(c) for c in m[0] if c.isdigit()][::-1]
        total = sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])
        if 13 <= len(d) <= 19 and total % 10 == 0:
            out.append(("card", *m.span()))
    return out + [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]


def some(seed, n=60):
    rng = random.Random(seed)
    kinds = [
        lambda: f"u{rng.randrange(99)}@mail{rng.randrange(9)}.example.com",
        lambda: ".".join(str(rng.randrange(300)) for _ in range(4)),
        lambda: "4539 1488 0343 6467",
        lambda: f"+1 ({rng.randrange(999)}) 555-{rng.randrange(9999):04}",
        lambda: "word",
        lambda: "thé",
    ]
    return [" ".join(rng.choice(kinds)() if rng.random() < 0.2 else "lorem" for _ in range(rng.randrange(60))) for _ in range(n)]


def test_base_equals_plain_patterns():
    rng = random.Random(3)
    texts = ["".join(rng.choice("ab1234567890.@+-() é%_") for _ in range(rng.randrange(80))) for _ in range(4000)]
    texts += ["a@b@c.d.e", "x..y@-.-", "@@a@b.c", "1.2.3.4.5.6.7.8", "001.2.3.4", "1" * 20, "0000255.1.1.1", "+1" + "." * 50, "²³+1 2²3456789"]
    for text in texts:
        assert pii.base_matches(text)[0] == plain_base(text), text


def test_runs_of_characters_take_linear_time():
    assert len(pii.base_matches("1." * 150_000)[0]) == 37_500
    for text in ("a" * 300_000, "1" * 300_000, "+1" + "(" * 300_000, "@" * 200_000, "1 " * 100_000):
        assert pii.base_matches(text)[0] == []


def test_gradients():
    model = Tagger(3, np.ones((3, 3), bool), 4, 5)
    model.p = {k: v.astype(float) for k, v in model.p.items()}
    ids, mask = characters(["abc1", "x", "12 é"], 4)
    tags = np.array([[0, 1, 2], [1, 0, 0], [2, 0, 1], [0, 0, 2]])
    mask = mask.astype(float)
    grads = model._gradients(ids, mask, tags)[1]
    for name, value in model.p.items():
        at = np.unravel_index(np.abs(grads[name]).argmax(), value.shape)
        loss = []
        for step in (1e-4, -2e-4):
            value[at] += step
            loss.append(model._gradients(ids, mask, tags)[0])
        value[at] += 1e-4
        assert abs((loss[0] - loss[1]) / 2e-4 - grads[name][at]) < 1e-2 * max(1, abs(grads[name][at])), name


def test_reconcile_takes_the_most_certain_set():
    spans = [("ip", 0, 5, 0.9), ("card", 3, 8, 0.95), ("phone", 6, 9, 0.9), ("phone", 6, 9, 0.8), ("ip", 20, 22, 0.5)]
    assert pii.reconcile(spans) == [("ip", 0, 5), ("phone", 6, 9), ("ip", 20, 22)]
    assert pii.reconcile([]) == []


def test_model_learns_and_adds_to_the_base(spark):
    docs = frame(spark, [*some(1, 250), *ODD])
    model = pii.fit(docs, 120)
    texts = some(2, 40)
    cut = [(t[s : s + pii.WIDTH], t, s) for t in texts for s in pii.windows(t)]
    tags, _ = model.decode(*characters([x for x, _, _ in cut], pii.WIDTH))
    right = total = 0
    for k, (window, text, start) in enumerate(cut):
        want = np.zeros(len(text), bool)
        for _, a, b in plain_base(text):
            want[a:b] = True
        own = want[start : start + len(window)]
        right += int(((tags[: len(window), k] > 0) == own).sum())
        total += len(window)
    assert right / total > 0.95
    rows = {r.doc_id: r for r in pii.with_spans(docs, model, ["doc_id"]).collect()}
    assert len(rows) == docs.count()
    for r in docs.select("doc_id", "text").collect():
        base = [tuple(x) for x in rows[r.doc_id].base]
        assert base == plain_base(r.text or "")
        assert set(base) <= {tuple(x) for x in rows[r.doc_id].spans}


def test_windows_cover_every_trigger():
    text = "x" * 300 + "1" + "y" * 500 + "@"
    for p in (300, 801):
        assert any(s <= p < s + pii.WIDTH for s in pii.windows(text))
    assert pii.windows("no digits") == [] and pii.windows("1") == [0]


def test_redaction_keeps_rows_and_columns(spark):
    docs = frame(spark, ["mail u1@mail.example.com now", "none", None, ""])
    out = pii.redacted(docs, None)
    assert out.columns == docs.columns
    rows = {r.doc_id: r for r in out.collect()}
    assert rows[0].text == "mail [EMAIL] now" and rows[0].n_chars == len(rows[0].text)
    assert rows[1].text == "none" and rows[2].text is None and rows[3].text == ""
    assert pii.replaced("abcdef", [("ip", 1, 4), ("card", 2, 5)]) == "a[IP]f"


def test_empty_table(spark):
    assert pii.fit(frame(spark, [])) is None
    assert pii.with_spans(frame(spark, []), None, ["doc_id"]).count() == 0
