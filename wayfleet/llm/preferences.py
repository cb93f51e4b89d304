"""Preference formatting of pairs of conversations.

The longest common prefix of turns (same role and text, one after another) is
rendered once as the prompt; what follows on each side is a completion, with
the character spans that count for the loss: the text and end mark of its
assistant turns.

Turns are ordered by (turn, role, text), null turns first; gaps in the numbers
do not matter, repeated rows are repeated turns.  A null role is a user, a null
text empty.  A conversation without turns gives an empty completion; a pair
whose sides are equal has two.  A conversation may be in many pairs.  Extra
columns of either input play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE, END = "<|", "|>\n", "<|end|>\n"


def _head(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), turn["role"], F.lit(CLOSE))


def _rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda x: F.concat(_head(x), x["text"], F.lit(END))), "")


def _mask(turns: Column) -> Column:
    """Spans (start, end) of what assistants say, in characters."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def add(state: Column, turn: Column) -> Column:
        after = state["at"] + F.length(_head(turn)) + F.length(turn["text"]) + len(END)
        span = F.struct((state["at"] + F.length(_head(turn))).alias("start"), after.alias("end"))
        spans = F.when(turn["role"] == "assistant", F.array_append(state["spans"], span)).otherwise(state["spans"])
        return F.struct(after.alias("at"), spans.alias("spans"))

    return F.aggregate(turns, start, add)["spans"]


def formatted(turns: DataFrame, pairs: DataFrame) -> DataFrame:
    """pair_id, chosen_id, rejected_id, n_common (turns of the prompt), prompt,
    and for each side the completion and its mask (array of start, end).

    ``turns``: conv_id, turn, role, text.  ``pairs``: pair_id (unique), chosen_id,
    rejected_id.  One join and one aggregation, whose group is a pair: its row
    holds the turns of both sides anyway."""
    sides = pairs.select(
        "pair_id", "chosen_id", "rejected_id",
        F.inline(
            F.array(
                F.struct(F.col("chosen_id").alias("conv_id"), F.lit(True).alias("chosen")),
                F.struct(F.col("rejected_id").alias("conv_id"), F.lit(False).alias("chosen")),
            )
        ),
    )
    narrow = turns.select(
        "conv_id",
        F.struct(
            F.col("turn").cast("long").alias("turn"),
            F.coalesce(F.col("role").cast("string"), F.lit("user")).alias("role"),
            F.coalesce("text", F.lit("")).alias("text"),
        ).alias("said"),
    )
    joined = sides.join(narrow, "conv_id", "left").groupBy("pair_id", "chosen_id", "rejected_id").agg(
        F.sort_array(F.collect_list(F.when(F.col("chosen"), F.col("said")))).alias("c"),
        F.sort_array(F.collect_list(F.when(~F.col("chosen"), F.col("said")))).alias("r"),
    )
    same = F.zip_with(
        "c", "r", lambda a, b: a["role"].eqNullSafe(b["role"]) & a["text"].eqNullSafe(b["text"])
    )
    joined = joined.withColumn("__at", F.array_position(same, False)).withColumn(
        "n_common", F.when(F.col("__at") > 0, F.col("__at") - 1).otherwise(F.size("c")).cast("int")
    )

    def rest(side: str) -> Column:
        return F.slice(side, F.col("n_common") + 1, F.greatest(F.size(side) - F.col("n_common"), F.lit(0)))

    joined = joined.withColumn("__prompt", F.slice("c", 1, F.col("n_common"))).withColumn("c", rest("c")).withColumn("r", rest("r"))
    return joined.select(
        "pair_id", "chosen_id", "rejected_id", "n_common",
        _rendered(F.col("__prompt")).alias("prompt"),
        _rendered(F.col("c")).alias("chosen"),
        _mask(F.col("c")).alias("chosen_mask"),
        _rendered(F.col("r")).alias("rejected"),
        _mask(F.col("r")).alias("rejected_mask"),
    )
