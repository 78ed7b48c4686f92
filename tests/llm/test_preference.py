from gridtide.llm.preference import format_preferences
from pyspark.sql import functions as F


def formatted(spark, rows):
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, prompt string, chosen string")
    done = format_preferences(turns, F.floor(F.col("conv_id") / 2), F.pmod("conv_id", F.lit(2)) == 0)
    return {r["pair_id"]: r for r in done.collect()}


def said(conv, *turns):
    return [(conv, i, role, text, "clash", "clash") for i, (role, text) in enumerate(turns)]


def test_common_turns_are_the_prompt(spark):
    a = [("system", "s"), ("user", "u"), ("assistant", "yes"), ("user", "more"), ("assistant", "é👍")]
    b = [("system", "s"), ("user", "u"), ("assistant", "no")]
    got = formatted(spark, said(0, *a) + said(1, *b) + said(1, *b))[0]
    assert got["prompt"] == "<|system|>\ns\n<|user|>\nu\n" and got["n_prompt_turns"] == 2
    assert got["chosen"] == "<|assistant|>\nyes\n<|user|>\nmore\n<|assistant|>\né👍\n"
    assert got["rejected"] == "<|assistant|>\nno\n"
    masked = [got["chosen"][int(s) : int(e)] for s, e in (x.split(":") for x in got["chosen_mask"].split(","))]
    assert masked == ["yes\n", "é👍\n"] and got["rejected_mask"] == "14:17"


def test_lone_equal_and_awkward_conversations(spark):
    same = [("user", "u"), ("assistant", "a")]
    rows = said(2, *same) + said(3, *same) + said(4, ("user", "only")) + said(7, (None, None)) + said(6, (None, "x"))
    rows += [(None, 0, "user", "x", "c", "c"), (8, None, "user", "x", "c", "c")]
    got = formatted(spark, rows)
    assert set(got) == {1, 2, 3}
    assert (got[1]["n_prompt_turns"], got[1]["chosen"], got[1]["rejected"]) == (2, "", "")
    assert (got[2]["prompt"], got[2]["chosen"], got[2]["rejected"]) == ("", "<|user|>\nonly\n", "")
    assert (got[3]["chosen"], got[3]["rejected"]) == ("<|unknown|>\nx\n", "<|unknown|>\n\n")
    assert formatted(spark, [])  == {}
