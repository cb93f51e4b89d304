"""Benchmark decontamination by template canonicalisation, in DataFrame functions.

Numbers, names and units become typed placeholders, so that a question asked
again with other values keeps its template.  Every window of ``WINDOW`` template
words of a document is hashed and joined with the windows of the benchmark
items, and so is every window of the plain words: a window counts if either is
equal, so that a copy in other letter case is found although its names are not
seen as names.  Where placeholders are involved, the values must be exchanged
consistently: within one alignment of a document and an item, one value of the
item stands for one value of the document; where it does not, windows with that
value count only if their plain words are equal.  A document is contaminated by
an item if such windows cover at least ``COVERAGE`` of the item's windows.

A number is a run of digits with inner dots and commas; a unit is one of UNITS
after a number; a name is a capitalised word after a space that does not begin a
sentence; runs of white space count as one space.  Words are what ASCII white
space and punctuation separate, in lower case.  Items with fewer words than a window are one window as long as they
are; items without a word match nothing.

Null and empty texts have no windows.  Rows that share a doc_id (or an item_id)
are one document (or item) with the windows of all.  Repeated rows change
nothing.  Documents without a doc_id go by their text, so equal ones are one
document, whose doc_id is null in the result; items without an id are left out.
``without_contaminated`` judges every row by its own text, whatever its id.
An empty table of documents or of items contaminates nothing; texts may be of
any length; other columns play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfleet.llm.work import broadcast_if_few, stored, unused

WINDOW = 8
COVERAGE = 0.5
#: Item windows up to this number (24 bytes each) are broadcast; more are joined
#: by shuffling.
BROADCAST_WINDOWS = 1_000_000
#: Units of measure, money and time, in lower case.
UNITS = (
    "mm cm m km in ft yd mi mg g kg lb oz ml l gal ms s sec min h hr hrs hour hours minute minutes second seconds "
    "day days week weeks month months year years mph kph kmh hz khz mhz ghz w kw mw kwh v a j kj cal kcal "
    "dollar dollars cent cents euro euros pound pounds usd eur gbp percent degrees miles meters metres feet inches "
    "grams kilograms liters litres tons"
).split()
_NUMBER, _UNIT, _NAME, _POINT = "\ue000", "\ue001", "\ue002", "\ue003"
_CAPITAL, _SMALL = "A-ZÀ-ÖØ-Þ", "a-zß-öø-ÿ"
_SEPARATORS = r"[\x00-\x20!-/:-@\[-`{-~\x7F]+"


def marked(text: Column, values: bool) -> Column:
    """The text with each number, name and unit as a mark, followed by its
    value if ``values``.  Both forms have the same words at the same places."""
    text = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " "))
    own = "$1" if values else ""
    name = rf" ([{_CAPITAL}](?<![.!?:\s] .)[{_SMALL}][\p{{L}}]*)"
    text = F.regexp_replace(text, name, f" {_NAME}{own} ")
    numbers = F.regexp_replace(text, r"(?<=[0-9])[.,](?=[0-9])", _POINT)
    numbers = F.regexp_replace(numbers, rf"([0-9{_POINT}]+)", f" {_NUMBER}{own} ")
    units = "|".join(sorted(UNITS, key=len, reverse=True))
    value = rf"[0-9{_POINT}]{{1,30}}" if values else ""
    numbers = F.regexp_replace(
        numbers, rf"(?<={_NUMBER}{value} {{1,3}})((?i:{units}))(?![\p{{L}}\p{{N}}])", f"{_UNIT}{own}"
    )
    return F.when(text.rlike("[0-9]"), numbers).otherwise(text)


def words(marked_text: Column) -> Column:
    """The words, in lower case."""
    return F.array_remove(F.split(F.lower(marked_text), _SEPARATORS), "")


def _is_marked(word: Column) -> Column:
    """Whether a mark begins the word (strings that do sort together)."""
    return (word >= _NUMBER) & (word < _POINT)


def _plain(word: Column) -> Column:
    """A word of ``marked(..., values=True)`` as it stands in the text, in lower case."""
    return F.when(_is_marked(word), F.substring(word, 2, 1 << 30)).otherwise(word)


def _bound(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _paired(hashes: Column, step: int) -> Column:
    """Each element combined with the one ``step`` further on."""
    return _bound(
        hashes,
        lambda h: F.zip_with(
            h, F.slice(h, step + 1, F.greatest(F.size(h) - step, F.lit(0))), lambda a, b: F.xxhash64(a, b)
        ),
    )


def _windows(frame: DataFrame, key: str, lengths: list[int]) -> DataFrame:
    """(key, size, pos, window, hash, exact) of every window of the lengths,
    positions from 0: ``window`` is the template's hash; ``hash`` is that or,
    in a row of its own where it differs, the plain words'; ``exact`` tells
    that no placeholder is in what was hashed.

    Hashes of one word are combined to those of two, four, ... words, and the
    last step lets both halves overlap."""
    text = frame.select(key, words(marked(F.col("text"), values=True)).alias("__words"))
    plain = text.withColumn("p", F.transform("__words", lambda x: F.xxhash64(_plain(x))))
    hashed = plain.select(
        key,
        F.size("p").alias("__n"),
        "p",
        F.zip_with("__words", "p", lambda x, p: F.when(_is_marked(x), F.xxhash64(F.substring(x, 1, 1))).otherwise(p)).alias("t"),
    )
    out = None
    for size in lengths:
        forms = []
        for form in ("t", "p"):
            hashes, width = F.col(form), 1
            while width < size:
                step = min(width, size - width)
                hashes, width = _paired(hashes, step), width + step
            forms.append(hashes.alias(form))
        part = hashed.select(key, "__n", *forms).select(key, "__n", F.posexplode(F.arrays_zip("t", "p")).alias("pos", "h"))
        part = part.where(F.col("pos") <= F.col("__n") - size).select(key, F.lit(size).alias("size"), "pos", "h.t", "h.p")
        forms = F.when(F.col("t") == F.col("p"), F.array("p")).otherwise(F.array("t", "p"))
        part = part.withColumn("hash", F.explode(forms))
        part = part.select(key, "size", "pos", F.col("t").alias("window"), "hash", (F.col("hash") == F.col("p")).alias("exact"))
        out = part if out is None else out.unionByName(part)
    return out


def _text_key() -> Column:
    """128 bits of the text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return F.concat(F.lit("t"), F.hex(F.xxhash64(text)), F.hex(F.xxhash64(text, F.lit(7))))


def contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW, coverage: float = COVERAGE) -> DataFrame:
    """doc_id, item_id, n_windows (of the item), n_matched, n_slots (compared
    values) and n_changed (values that differ), for each contaminated pair."""
    key = F.coalesce(F.concat(F.lit("d"), F.col("doc_id").cast("string")), _text_key())
    found = _contaminated(docs.select(key.alias("doc"), "text"), items, window, coverage)
    own = F.when(F.col("doc").startswith("d"), F.substring("doc", 2, 1 << 30).cast(docs.schema["doc_id"].dataType))
    return found.select(own.alias("doc_id"), *found.columns[1:])


def _contaminated(docs: DataFrame, items: DataFrame, window: int, coverage: float) -> DataFrame:
    """As ``contaminated``, for documents (doc, text)."""
    items = items.select("item_id", "text").where("item_id IS NOT NULL")
    size = F.least(F.lit(window), F.size(words(marked(F.col("text"), values=False))))
    per_item, _ = stored(items.withColumn("__size", size).where("__size > 0"), "items")
    lengths = sorted(r[0] for r in per_item.select("__size").distinct().collect()) or [window]
    item_windows = None
    for n in lengths:
        part = _windows(per_item.where(F.col("__size") == n), "item_id", [n])
        item_windows = part if item_windows is None else item_windows.unionByName(part)
    item_windows, _ = stored(item_windows.withColumnRenamed("pos", "item_pos").distinct(), "item-windows")
    totals = item_windows.groupBy("item_id").agg(F.count_distinct("size", "window").alias("n_windows"))
    side = F.broadcast(item_windows) if item_windows.count() <= BROADCAST_WINDOWS else item_windows
    doc_windows = _windows(docs, "doc", lengths).drop("window", "exact")
    matches, _ = stored(doc_windows.join(side, ["hash", "size"]), "matches")
    covered = matches.groupBy("doc", "item_id").agg(F.count_distinct("size", "window").alias("n"))
    enough = covered.join(totals, "item_id").where(F.col("n") >= coverage * F.col("n_windows"))
    enough, _ = stored(enough.drop("n"), "enough")
    matches = matches.join(enough, ["doc", "item_id"]).withColumn("diagonal", F.col("pos") - F.col("item_pos"))

    # Values at the placeholders of the pairs that match so far.
    def with_values(frame: DataFrame, key: str, name: str) -> DataFrame:
        return frame.select(key, words(marked(F.col("text"), values=True)).alias(name))

    suspects, _ = stored(enough.select("doc").distinct(), "suspects")
    wanted = docs.join(broadcast_if_few(suspects), "doc", "left_semi")
    slotted = with_values(items, "item_id", "__item").where(F.exists("__item", _is_marked))
    pairs = F.zip_with(
        F.slice("__item", F.col("item_pos") + 1, F.col("size")),
        F.slice("__doc", F.col("pos") + 1, F.col("size")),
        lambda a, b: F.struct(a.alias("a"), _plain(b).alias("b")),
    )
    slots = matches.join(slotted, "item_id").join(with_values(wanted, "doc", "__doc"), "doc").select(
        "doc", "item_id", "diagonal",
        F.explode(F.filter(pairs, lambda x: _is_marked(x["a"]))).alias("s"),
    ).groupBy("doc", "item_id", "diagonal", F.col("s.a").alias("a")).agg(
        F.min("s.b").alias("low"), F.max("s.b").alias("high")
    )
    same = F.col("low") == F.col("high")
    verdicts = slots.groupBy("doc", "item_id", "diagonal").agg(
        F.collect_set(F.when(~same, F.col("a"))).alias("inconsistent"),
        F.count_if(same).alias("n_slots"),
        F.count_if(same & (_plain(F.col("a")) != F.col("low"))).alias("n_changed"),
    )
    inside = F.slice("__item", F.col("item_pos") + 1, F.col("size"))
    kept = matches.join(verdicts, ["doc", "item_id", "diagonal"], "left").join(slotted, "item_id", "left").where(
        F.col("exact") | ~F.coalesce(F.arrays_overlap(inside, "inconsistent"), F.lit(False))
    )
    out = kept.groupBy("doc", "item_id", "n_windows").agg(
        F.count_distinct("size", "window").alias("n_matched"),
        F.coalesce(F.max("n_slots"), F.lit(0)).alias("n_slots"),
        F.coalesce(F.max("n_changed"), F.lit(0)).alias("n_changed"),
    )
    return out.where(F.col("n_matched") >= coverage * F.col("n_windows"))


def without_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows whose text no item contaminates."""
    found = _contaminated(docs.select(_text_key().alias("doc"), "text"), items, WINDOW, COVERAGE)
    keyed = docs.withColumn(key := unused(docs, "doc_key"), _text_key())
    gone, _ = stored(found.select(F.col("doc").alias(key)).distinct(), "contaminated")
    kept = keyed.join(broadcast_if_few(gone), key, "left_anti")
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
