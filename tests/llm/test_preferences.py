from __future__ import annotations

from wayfleet.llm import preferences


def shown(*turns):
    return "".join(f"<|{role}|>\n{text}<|end|>\n" for role, text in turns)


def run(spark, turns, pairs):
    said = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS pair_id", "2 AS chosen")
    frame = spark.createDataFrame(pairs, "pair_id long, chosen_id long, rejected_id long")
    return {r.pair_id: r for r in preferences.formatted(said, frame).collect()}


def test_prompt_completions_and_masks(spark):
    same = [(0, "system", "be"), (1, "user", "q"), (3, "assistant", "a")]
    turns = [(1, *x) for x in [*same, (5, "user", "more"), (7, "assistant", "goodé")]]
    turns += [(2, n + 10, r, t) for n, r, t in same] + [(2, 90, "user", "more"), (2, 91, "assistant", None)]
    turns += [(3, 0, "user", "q"), (4, 0, None, "q"), (4, 1, "assistant", "x" * 20_000), (None, 0, "user", "lost")]
    turns += [(5, None, "user", "first"), (5, 0, "user", "tie"), (5, 0, "assistant", "tie")]
    got = run(spark, turns, [(10, 1, 2), (11, 3, 4), (12, 1, 1), (13, 5, 99), (14, 98, 99)])
    one = got[10]
    prompt = [x[1:] for x in [*same, (0, "user", "more")]]
    assert one.n_common == 4 and one.prompt == shown(*prompt)
    assert one.chosen == shown(("assistant", "goodé")) and one.rejected == shown(("assistant", ""))
    (span,) = one.chosen_mask
    assert one.chosen[span.start : span.end] == "goodé<|end|>\n"
    assert got[11].prompt == shown(("user", "q")) and got[11].chosen == "" and got[11].chosen_mask == []
    assert got[12].n_common == 5 and got[12].chosen == got[12].rejected == ""
    assert got[13].chosen == shown(("user", "first"), ("assistant", "tie"), ("user", "tie")) and got[13].rejected == ""
    assert got[14].n_common == 0 and got[14].prompt == ""


def test_empty_tables(spark):
    assert run(spark, [], [(1, 2, 3)])[1].chosen == ""
    assert run(spark, [(1, 0, "user", "x")], []) == {}
