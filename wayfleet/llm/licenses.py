"""Licence scan by sentence rules, in DataFrame functions.

Texts are cut after ``. ! ?`` before white space, and at lines without a letter
or digit.  A piece over several lines that is a known sentence is one, however
it is wrapped and whatever comment signs stand before its lines; any other piece
is cut at its line ends.  Sentences go in lower case with everything but letters
and digits as one blank; those of fewer than two characters (list numbers) and
lines that are an address of the web are passed over and have no place.

A sentence is looked up among known licence sentences; ``copyright`` with a year
is a sentence of its own kind.  Identifiers of sentences that follow each other
are one sequence, and rules are tried on it in their order: a rule matches where
its identifiers stand one after another.  Earlier rules win sentences from
later ones.  Sentences that are known or mention a licence and are part of no
rule that matched are reported as unrecognised.

Null and empty texts have no sentences, and a long text is cut as a whole.  Rows
that share a doc_id are one document: the same sentence at the same place counts
once.  Rows without a doc_id are told apart by their text.  Other columns, whatever
their names, are not read; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# -- fixed values: known sentences and rules -----------------------------------
SENTENCES = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "mit-grant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "mit-notice",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "mit-as-is",
    "released under the mit license": "mit-reference",
    "licensed under the mit license": "mit-reference",
    "this project is licensed under the mit license": "mit-reference",
    "licensed under the apache license version 2 0": "apache-2-reference",
    "licensed under the apache license version 2 0 the license": "apache-2-reference",
    "you may not use this file except in compliance with the license": "apache-comply",
    "you may obtain a copy of the license at": "apache-copy",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied": "apache-as-is",
    "see the license for the specific language governing permissions and limitations under the license": "apache-limits",
    "this work is licensed under the gnu general public license version 3": "gpl-3-reference",
    "licensed under the gnu general public license version 3": "gpl-3-reference",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "gpl-3-later",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version": "gpl-2-later",
    "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose": "gpl-no-warranty",
    "see the gnu general public license for more details": "gpl-details",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd-grant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "bsd-source",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "bsd-binary",
    "licensed under cc by 4 0": "cc-by-4-reference",
    "licensed under cc by sa 4 0": "cc-by-sa-4-reference",
    "licensed under cc by nc 4 0": "cc-by-nc-4-reference",
    "this file is released into the public domain": "public-domain",
    "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software": "mit-liability",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "bsd-endorse",
    "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed": "bsd-as-is",
    "in no event shall the copyright holder or contributors be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage": "bsd-liability",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "isc-grant",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted": "0bsd-grant",
    "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness": "isc-as-is",
    "in no event shall the author be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other tortious action arising out of or in connection with the use or performance of this software": "isc-liability",
    "this source code form is subject to the terms of the mozilla public license v": "mpl-subject",
    "2 0": "version-2",
    "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0": "mpl-copy",
    "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0": "mpl-copy",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version": "agpl-3-later",
    "see the gnu affero general public license for more details": "agpl-details",
    "you should have received a copy of the gnu affero general public license along with this program": "agpl-received",
    "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version": "lgpl-21-later",
    "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version": "lgpl-3-later",
    "this library is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose": "lgpl-no-warranty",
    "see the gnu lesser general public license for more details": "lgpl-details",
    "you should have received a copy of the gnu general public license along with this program": "gpl-received",
    "if not see https www gnu org licenses": "gnu-see",
    "if not see http www gnu org licenses": "gnu-see",
    "this is free and unencumbered software released into the public domain": "unlicense-grant",
    "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means": "unlicense-anyone",
    "spdx license identifier mit": "mit-reference",
    "spdx license identifier apache 2 0": "apache-2-reference",
    "spdx license identifier gpl 3 0 only": "gpl-3-reference",
    "spdx license identifier bsd 3 clause": "bsd-3-reference",
    "spdx license identifier bsd 2 clause": "bsd-2-reference",
    "spdx license identifier isc": "isc-reference",
    "spdx license identifier mpl 2 0": "mpl-2-reference",
    "licensed under the bsd 3 clause license": "bsd-3-reference",
    "licensed under the bsd 2 clause license": "bsd-2-reference",
    "licensed under the isc license": "isc-reference",
    "licensed under the mozilla public license version 2 0": "mpl-2-reference",
    "all rights reserved": "reserved",
}
COPYRIGHT = "copyright"
UNRECOGNISED = "unrecognised"
#: In order: licence, and the identifiers that state it.
RULES = (
    ("MIT", ("mit-grant", "mit-notice", "mit-as-is", "mit-liability")),
    ("MIT", ("mit-grant", "mit-notice", "mit-as-is")),
    ("MIT", ("mit-grant", "mit-notice")),
    ("Apache-2.0", ("apache-2-reference", "apache-comply", "apache-copy", "apache-as-is", "apache-limits")),
    ("Apache-2.0", ("apache-2-reference", "apache-comply", "apache-copy")),
    ("AGPL-3.0-or-later", ("agpl-3-later", "gpl-no-warranty", "agpl-details", "agpl-received", "gnu-see")),
    ("AGPL-3.0-or-later", ("agpl-3-later", "gpl-no-warranty", "agpl-details")),
    ("AGPL-3.0-or-later", ("agpl-3-later",)),
    ("LGPL-2.1-or-later", ("lgpl-21-later", "lgpl-no-warranty", "lgpl-details")),
    ("LGPL-2.1-or-later", ("lgpl-21-later",)),
    ("LGPL-3.0-or-later", ("lgpl-3-later", "lgpl-no-warranty", "lgpl-details")),
    ("LGPL-3.0-or-later", ("lgpl-3-later",)),
    ("GPL-3.0-or-later", ("gpl-3-later", "gpl-no-warranty", "gpl-details", "gpl-received", "gnu-see")),
    ("GPL-3.0-or-later", ("gpl-3-later", "gpl-no-warranty", "gpl-details")),
    ("GPL-3.0-or-later", ("gpl-3-later",)),
    ("GPL-2.0-or-later", ("gpl-2-later", "gpl-no-warranty", "gpl-details", "gpl-received", "gnu-see")),
    ("GPL-2.0-or-later", ("gpl-2-later", "gpl-no-warranty", "gpl-details")),
    ("GPL-2.0-or-later", ("gpl-2-later",)),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse", "bsd-as-is", "bsd-liability")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-as-is", "bsd-liability")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("ISC", ("isc-grant", "isc-as-is", "isc-liability")),
    ("ISC", ("isc-grant",)),
    ("0BSD", ("0bsd-grant", "isc-as-is", "isc-liability")),
    ("0BSD", ("0bsd-grant",)),
    ("MPL-2.0", ("mpl-subject", "version-2", "mpl-copy")),
    ("MPL-2.0", ("mpl-subject", "version-2")),
    ("Unlicense", ("unlicense-grant", "unlicense-anyone")),
    ("Unlicense", ("unlicense-grant",)),
    ("BSD-3-Clause", ("bsd-3-reference",)),
    ("BSD-2-Clause", ("bsd-2-reference",)),
    ("ISC", ("isc-reference",)),
    ("MPL-2.0", ("mpl-2-reference",)),
    ("Apache-2.0", ("apache-2-reference",)),
    ("MIT", ("mit-reference",)),
    ("GPL-3.0-only", ("gpl-3-reference",)),
    ("CC-BY-4.0", ("cc-by-4-reference",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-4-reference",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-4-reference",)),
    ("Public-Domain", ("public-domain",)),
    ("All-Rights-Reserved", (COPYRIGHT, "reserved")),
    ("All-Rights-Reserved", ("reserved",)),
)
_MENTION = r"licen[cs]e|copyright"
#: Sentences that say something of a licence only as part of a rule.
_PLAIN = ("2 0",)
_SENTENCE_END, _GAP = r"([.!?])[ \t\x0B\f\r\n]+", r"\n[^a-zA-Z0-9\x01]*\n"
_ADDRESS = r"^[^a-zA-Z0-9]*https?://[^ \t\r]*[ \t\r]*$"
_COPYRIGHT = r"^copyright (c )?[12][0-9]{3}( |$)"


def normal(sentence: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(sentence), "[^a-z0-9]+", " "))


def sentences(docs: DataFrame) -> DataFrame:
    """doc, doc_id, place and identifier of the sentences that are known or
    mention a licence; identifier null for the latter.  ``doc`` tells documents
    apart."""
    text = F.coalesce("text", F.lit(""))
    ended = F.regexp_replace(text, _SENTENCE_END, "$1\x01")
    pieces = F.split(F.regexp_replace(ended, _GAP, "\x01"), "\x01")
    known = list(SENTENCES)
    wrapped = lambda x: x.contains("\n") & ~normal(x).isin(known)
    lines = F.flatten(F.transform(pieces, lambda x: F.when(wrapped(x), F.split(x, "\n")).otherwise(F.array(x))))
    plain = F.transform(lines, lambda x: F.when(x.rlike(_ADDRESS), "").otherwise(normal(x)))
    said = F.filter(plain, lambda x: F.length(x) > 1)
    doc = F.coalesce(F.concat(F.lit("i"), F.col("doc_id").cast("string")), F.concat(F.lit("t"), F.md5(text)))
    found = docs.select(doc.alias("doc"), "doc_id", F.posexplode(said).alias("place", "sentence"))
    is_known = F.col("sentence").isin(known)
    found = found.where(is_known | F.col("sentence").rlike(_MENTION)).distinct()
    lookup = F.create_map(*[F.lit(x) for pair in SENTENCES.items() for x in pair])
    identifier = F.when(is_known, F.element_at(lookup, F.col("sentence"))).when(
        F.col("sentence").rlike(_COPYRIGHT), COPYRIGHT
    )
    return found.select("doc", "doc_id", "place", "sentence", identifier.alias("identifier"))


def rules(spark: SparkSession) -> DataFrame:
    rows = [(k, licence, list(ids), ids[0], len(ids)) for k, (licence, ids) in enumerate(RULES)]
    return spark.createDataFrame(rows, "rule int, licence string, ids array<string>, identifier string, size int")


def licences(docs: DataFrame) -> DataFrame:
    """doc_id, place (of the first sentence), licence, rule (its place in the
    order, null if unrecognised) and n_sentences of everything found.

    Sentences of licences are few in any text; those that follow each other
    meet in windows over (document, run)."""
    found = sentences(docs)
    by_place = Window.partitionBy("doc").orderBy("place")
    found = found.withColumn("run", F.col("place") - F.row_number().over(by_place))
    run = Window.partitionBy("doc", "run").orderBy("place")
    longest = max(len(ids) for _, ids in RULES)
    ahead = run.rowsBetween(0, longest - 1)
    ids = F.collect_list(F.coalesce("identifier", F.lit(""))).over(ahead)
    table = F.broadcast(rules(docs.sparkSession))
    tried = found.withColumn("ids", ids).join(table.withColumnRenamed("ids", "wanted"), "identifier", "left")
    matches = F.slice("ids", 1, F.coalesce("size", F.lit(1))) == F.col("wanted")
    none = F.struct(F.lit(len(RULES)).alias("rule"), F.lit(None).cast("string").alias("licence"), F.lit(1).alias("size"))
    # The first rule of each place; places covered by an earlier rule go.
    best = F.min(F.when(matches, F.struct("rule", "licence", "size")).otherwise(none)).alias("best")
    spans = tried.groupBy("doc", "doc_id", "run", "place", "sentence").agg(best).select(
        "doc", "doc_id", "run", "place", "sentence", "best.*"
    )
    around = Window.partitionBy("doc", "run").orderBy("place").rowsBetween(-(longest - 1), longest - 1)
    near = F.collect_list(F.struct("rule", "place", "size")).over(around)
    last = F.col("place") + F.col("size")
    beaten = F.exists(
        near,
        lambda x: (x["rule"] < F.col("rule")) & (x["place"] < last) & (x["place"] + x["size"] > F.col("place"))
        | (x["rule"] == F.col("rule")) & (x["place"] < F.col("place")) & (x["place"] + x["size"] > F.col("place")),
    )
    kept = spans.withColumn("beaten", beaten).where(~F.col("beaten"))
    known = F.col("rule") < len(RULES)
    return kept.where(known | ~F.col("sentence").isin(list(_PLAIN))).select(
        "doc_id",
        "place",
        F.when(known, F.col("licence")).otherwise(UNRECOGNISED).alias("licence"),
        F.when(known, F.col("rule")).alias("rule"),
        F.col("size").alias("n_sentences"),
    )
