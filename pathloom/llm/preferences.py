"""Preference data: chosen and rejected conversations with their common turns as prompt.

The prompt of a pair is the longest common prefix of turns (role and text alike, null alike null); it is
rendered once, and what follows in either conversation is its completion. In a completion only the
assistant's texts are learned: `*_mask` lists their spans, [start, end) in characters of the completion.
A turn is rendered as `<|role|>\\n`, its text, `<|end|>\\n`.

The turns of a pair are gathered once, by its id, so the texts travel once; the hot first turn that many
conversations begin with is no key of anything.

Defined results: a conversation that is missing counts as one without turns; turns of one number are
taken in the order of role and text, nulls first, and equal ones once; a null role or text is rendered
as empty, turns without conversation or number are left out; two equal conversations have two empty
completions; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROLE_LEARNED = "assistant"


def neighbours(turns: DataFrame) -> DataFrame:
    """As `format_pairs` of plain conversations: the even ones are chosen, the next ones rejected.

    A rejected conversation takes over the first turn of the chosen one where both begin with the same
    role, as two answers to one question would.
    """
    rows = turns.where("conv_id IS NOT NULL AND turn IS NOT NULL")
    pair_id, chosen = F.floor(F.col("conv_id") / 2).alias("pair_id"), F.pmod("conv_id", F.lit(2)) == 0
    pairs = _gathered(rows.select(pair_id, chosen.alias("chosen"), "turn", "role", "text"))

    def taken_over(t: Column) -> Column:
        first = F.filter("c", lambda x: (x["turn"] == 0) & x["role"].eqNullSafe(t["role"]))
        text = F.when((t["turn"] == 0) & (F.size(first) > 0), F.array_min(F.transform(first, lambda x: x["text"]))).otherwise(t["text"])
        return F.struct(t["turn"].alias("turn"), t["role"].alias("role"), text.alias("text"))

    return _formatted(pairs.withColumn("r", F.array_distinct(F.transform("r", taken_over))))


def _gathered(rows: DataFrame) -> DataFrame:
    """pair_id and the distinct turns of both sides, from rows (pair_id, chosen, turn, role, text): the texts travel once."""
    turn = F.struct("turn", "role", "text")
    sides = {"c": F.col("chosen"), "r": ~F.col("chosen")}
    return rows.groupBy("pair_id").agg(*[F.collect_set(F.when(is_side, turn)).alias(s) for s, is_side in sides.items()])


def _rendered(role: Column, text: Column) -> Column:
    return F.concat(F.lit("<|"), F.coalesce(role, F.lit("")), F.lit("|>\n"), F.coalesce(text, F.lit("")), F.lit("<|end|>\n"))


def _completion(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: t["shown"]), "")


def _mask(turns: Column) -> Column:
    """Spans of the learned texts: each turn starts where the ones before it end."""
    step = lambda acc, t: F.struct(
        (acc["at"] + F.length(t["shown"])).alias("at"),
        F.when(t["role"] == ROLE_LEARNED, F.concat(acc["spans"], F.array(F.array(acc["at"] + F.length(t["role"]) + 5, acc["at"] + F.length(t["shown"]) - 8)))).otherwise(acc["spans"]).alias("spans"),
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<array<int>>").alias("spans"))
    return F.aggregate(turns, start, step, lambda acc: acc["spans"])


def format_pairs(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """pair_id, prefix_turns, prompt, chosen, chosen_mask, rejected, rejected_mask, from turns (pair_id, turn, role, text) of both sides."""
    sides = [df.where("pair_id IS NOT NULL AND turn IS NOT NULL").select("pair_id", F.lit(c).alias("chosen"), "turn", "role", "text") for df, c in ((chosen, True), (rejected, False))]
    return _formatted(_gathered(sides[0].unionByName(sides[1])))


def _formatted(pairs: DataFrame) -> DataFrame:
    """Of both sides' turns (c, r) the common first ones as prompt, the others as completions."""
    plain = lambda side: F.transform(F.sort_array(side), lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    placed = pairs.select("pair_id", plain("c").alias("c"), plain("r").alias("r"))
    # A side that has ended differs from any turn.
    differs = F.transform(F.arrays_zip("c", "r"), lambda z: ~z["c"].eqNullSafe(z["r"]))
    longest = F.greatest(F.size("c"), F.size("r"))
    prefix = F.coalesce(F.nullif(F.array_position(differs, True), F.lit(0)) - 1, longest).cast("int")
    shown = lambda side: F.transform(side, lambda t: F.struct(t["role"].alias("role"), _rendered(t["role"], t["text"]).alias("shown")))
    placed = placed.select("pair_id", prefix.alias("prefix_turns"), shown("c").alias("c"), shown("r").alias("r"))
    after = lambda side: F.slice(side, F.col("prefix_turns") + 1, F.size(side))
    return placed.select(
        "pair_id",
        "prefix_turns",
        _completion(F.slice("c", F.lit(1), F.col("prefix_turns"))).alias("prompt"),
        _completion(after("c")).alias("chosen"),
        _mask(after("c")).alias("chosen_mask"),
        _completion(after("r")).alias("rejected"),
        _mask(after("r")).alias("rejected_mask"),
    )
