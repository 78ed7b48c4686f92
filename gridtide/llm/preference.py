"""Preference pairs: one prompt, two completions with their loss masks.

The turns of both conversations of a pair are laid side by side in one shuffle
on (pair, turn number). A pair's prompt is the longest run of leading turns in
which both agree in role and text; the turns after it are its two completions.
A group never holds more than one pair's turns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _rendered(role: Column, text: Column) -> Column:
    return F.concat(F.lit("<|"), role, F.lit("|>\n"), text, F.lit("\n"))


def _joined(turns: str, side: str, keep: Column) -> Column:
    """Rendered turns of one side in turn order; ``keep`` picks them."""
    picked = F.filter(F.col(turns), lambda t: t[side].isNotNull() & (t["in_prompt"] == keep))
    return F.array_join(F.transform(picked, lambda t: t[side]), "")


def _mask(turns: str, side: str) -> Column:
    """The trained stretches of a completion, as start:end in characters: the
    text and the line end of every assistant turn."""
    picked = F.filter(F.col(turns), lambda t: t[side].isNotNull() & ~t["in_prompt"])
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("spans"))

    def step(state: Column, turn: Column) -> Column:
        end = state["at"] + F.char_length(turn[side])
        head = state["at"] + turn[f"{side}_head"]
        span = F.concat(head.cast("string"), F.lit(":"), end.cast("string"))
        grown = F.when(turn[f"{side}_trained"], F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct(end.alias("at"), grown.alias("spans"))

    return F.aggregate(picked, start, step, lambda s: F.array_join(s["spans"], ","))


def format_preferences(
    turns: DataFrame,
    pair: Column,
    is_chosen: Column,
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    trained_role: str = "assistant",
) -> DataFrame:
    """Per pair: ``pair_id``, ``n_prompt_turns``, ``prompt``, ``chosen``,
    ``rejected``, ``chosen_mask``, ``rejected_mask``.

    A null role counts as ``unknown`` and a null text as empty. Turns without a
    pair, a side or a number are in no conversation. Of several turns under one
    number of one side the greatest (role, text) counts, so repeated rows
    change nothing. A side without turns gives an empty completion, and of two
    equal conversations all turns are prompt. Other columns are ignored.
    """
    one = turns.select(
        pair.alias("pair_id"),
        is_chosen.alias("chosen"),
        F.col(turn).cast("bigint").alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("unknown")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    ).filter("pair_id IS NOT NULL AND chosen IS NOT NULL AND turn IS NOT NULL")
    said = F.struct("role", "text")
    sides = one.groupBy("pair_id", "turn").agg(
        F.max(F.when(F.col("chosen"), said)).alias("a"), F.max(F.when(~F.col("chosen"), said)).alias("b")
    )

    def of(side: str, name: str) -> list[Column]:
        r, t = F.col(f"{side}.role"), F.col(f"{side}.text")
        return [
            _rendered(r, t).alias(name),
            (F.char_length(r) + 5).alias(f"{name}_head"),
            (r == trained_role).alias(f"{name}_trained"),
        ]

    laid = sides.select(
        "pair_id", F.struct("turn", F.col("a").eqNullSafe(F.col("b")).alias("same"), *of("a", "chosen"), *of("b", "rejected")).alias("t")
    )
    whole = laid.groupBy("pair_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    splits = whole.withColumn("split", F.array_min(F.transform(F.filter("turns", lambda t: ~t["same"]), lambda t: t["turn"])))
    marked = splits.withColumn(
        "turns",
        F.transform(
            "turns",
            lambda t: t.withField("in_prompt", F.col("split").isNull() | (t["turn"] < F.col("split"))),
        ),
    )
    return marked.select(
        "pair_id",
        F.size(F.filter("turns", lambda t: t["in_prompt"])).cast("bigint").alias("n_prompt_turns"),
        _joined("turns", "chosen", F.lit(True)).alias("prompt"),
        _joined("turns", "chosen", F.lit(False)).alias("chosen"),
        _joined("turns", "rejected", F.lit(False)).alias("rejected"),
        _mask("turns", "chosen").alias("chosen_mask"),
        _mask("turns", "rejected").alias("rejected_mask"),
    )


