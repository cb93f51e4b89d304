from __future__ import annotations

import textwrap
from collections import Counter

import duckdb
import pytest

from tests.llm.helpers import ODD, frame
from wayfleet.llm import licenses, oracle

LONG = {v: k for k, v in licenses.SENTENCES.items()}


def found(spark, texts):
    return sorted((r.doc_id, r.place, r.licence, r.n_sentences) for r in licenses.licences(frame(spark, texts)).collect())


def test_sequences_of_sentences(spark):
    mit = ". ".join(LONG[x] for x in ("mit-grant", "mit-notice", "mit-as-is")) + "."
    apache = "Licensed under the Apache License, Version 2.0 (the \"License\").\n" + "\n".join(
        LONG[x] for x in ("apache-comply", "apache-copy", "apache-as-is", "apache-limits")
    )
    texts = [
        f"Intro here. {mit} The end",
        apache,
        "Text.\nReleased under the MIT License.\nText. Licensed under CC BY-NC 4.0.",
        "Copyright (c) 2020 Someone. All rights reserved.",
        "This is under some odd licence.",
        "no such thing",
        *ODD,
        (9_000, "Released under the MIT License."),
        (9_000, "Released under the MIT License."),
    ]
    assert found(spark, texts) == [
        (0, 1, "MIT", 3),
        (1, 0, "Apache-2.0", 5),
        (2, 1, "MIT", 1),
        (2, 3, "CC-BY-NC-4.0", 1),
        (3, 0, "All-Rights-Reserved", 2),
        (4, 0, licenses.UNRECOGNISED, 1),
        (9_000, 0, "MIT", 1),
    ]
    assert found(spark, []) == []


def test_a_later_rule_gets_what_is_left(spark):
    text = "\n".join([LONG["mit-grant"], LONG["mit-notice"], "Licensed under CC BY 4.0", "Copyright 1999", "all rights reserved"])
    assert found(spark, [text]) == [(0, 0, "MIT", 2), (0, 2, "CC-BY-4.0", 1), (0, 3, "All-Rights-Reserved", 2)]


def wrapped(text, width, lead=""):
    return "\n".join(lead + x for x in textwrap.wrap(text, width))


def texts_of_licences(width, lead=""):
    """Standard texts as they stand at the head of files."""
    def paragraphs(*parts):
        return f"\n{lead}\n".join(wrapped(p, width, lead) for p in parts)

    apache = paragraphs(
        'Copyright 2020 Someone',
        'Licensed under the Apache License, Version 2.0 (the "License");',
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at",
        "    http://www.apache.org/licenses/LICENSE-2.0",
        'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed '
        'on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License '
        "for the specific language governing permissions and limitations under the License.",
    )
    mit = paragraphs("MIT License", "Copyright (c) 2021 A. Person", *(LONG[x].capitalize() + "." for x in ("mit-grant", "mit-notice")),
                     LONG["mit-as-is"].upper() + ". " + LONG["mit-liability"].upper() + ".")
    bsd = paragraphs(LONG["bsd-grant"] + ":", "1. " + LONG["bsd-source"] + ".", "2. " + LONG["bsd-binary"] + ".",
                     "3. " + LONG["bsd-endorse"] + ".", LONG["bsd-as-is"].upper() + ". " + LONG["bsd-liability"].upper() + ".")
    mpl = paragraphs("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
                     "was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.")
    agpl = paragraphs(LONG["agpl-3-later"] + ".", LONG["gpl-no-warranty"] + ". " + LONG["agpl-details"] + ".",
                      LONG["agpl-received"] + ". If not, see <https://www.gnu.org/licenses/>.")
    return [apache, mit, bsd, mpl, agpl, paragraphs(LONG["lgpl-21-later"] + "."), paragraphs(LONG["isc-grant"] + ".")]


def check_sql(spark, texts):
    docs = frame(spark, texts).select("doc_id", "text")
    db = duckdb.connect()
    db.register("documents", docs.toArrow())
    want = Counter(map(tuple, db.sql(oracle.oracle_sql()["op9_licence_sentence_rules"]).fetchall()))
    assert Counter(tuple(r) for r in licenses.licences(docs).collect()) == want
    return want


@pytest.mark.parametrize(("width", "lead"), [(72, ""), (60, "# "), (76, " * "), (10_000, "// ")])
def test_wrapped_licences(spark, width, lead):
    texts = texts_of_licences(width, lead)
    rows = check_sql(spark, texts)
    licence = {k: {r[2] for r in rows if r[0] == k and r[3] is not None} for k in range(len(texts))}
    names = ["Apache-2.0", "MIT", "BSD-3-Clause", "MPL-2.0", "AGPL-3.0-or-later", "LGPL-2.1-or-later", "ISC"]
    assert licence == {k: {name} for k, name in enumerate(names)}
    # All sentences of a text but its own heading and holder belong to the one rule.
    size = {r[0]: r[4] for r in rows if r[3] is not None}
    assert size == {0: 5, 1: 4, 2: 6, 3: 3, 4: 5, 5: 1, 6: 1}


def test_incomplete_sequences_are_reported(spark):
    texts = [LONG["mit-notice"] + ".", "2.0", "v. 2.0. x", LONG["bsd-grant"] + ":\n\n\n" + LONG["bsd-source"], "\n" * 50_000 + "a. " * 1000,
             (None, "Released under the MIT License."), (None, "All rights reserved."), (None, "All rights reserved."), *ODD]
    rows = check_sql(spark, texts)
    assert {(r[0], r[1], r[2]) for r in rows} == {
        (0, 0, licenses.UNRECOGNISED), (3, 0, licenses.UNRECOGNISED), (3, 1, licenses.UNRECOGNISED),
        (None, 0, "MIT"), (None, 0, "All-Rights-Reserved"),
    }
