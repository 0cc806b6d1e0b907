"""Preference formatting: common prompt, paired masked completions.

Turns come with a pair and a side. One shuffle by pair gathers the turns of both sides in
order; the longest common prefix of equal (role, text) turns is rendered once as the prompt,
what is left of each side is its completion. A completion's mask lists the code-point ranges
of the assistant's texts, on which alone a loss is taken. Column functions only.

Defined cases: a pair with one side only has an empty other side and no prompt; two equal
sides have empty completions; null roles and texts render as empty and are equal to each
other; turns repeated or with null turn numbers sort by (turn, role, text), nulls first; a
null pair is dropped, as no partner can be known; very long texts and conversations stay whole,
a pair being one row; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEARNT = "assistant"


def adjacent_pairs(turns: DataFrame) -> DataFrame:
    """Conversation 2k is chosen, 2k + 1 rejected, of pair k."""
    return turns.select(F.floor(F.col("conv_id") / 2).cast("long").alias("pair_id"), (F.pmod("conv_id", F.lit(2)) == 1).alias("rejected"), "turn", "role", "text")


def paired(turns: DataFrame, pairs: DataFrame) -> DataFrame:
    """Turns of the conversations named by pairs (pair_id, chosen_id, rejected_id)."""
    sides = pairs.select(
        "pair_id", F.explode(F.array(F.struct(F.col("chosen_id").alias("conv_id"), F.lit(False).alias("rejected")), F.struct(F.col("rejected_id").alias("conv_id"), F.lit(True).alias("rejected")))).alias("s")
    ).select("pair_id", "s.conv_id", "s.rejected")
    return turns.select("conv_id", "turn", "role", "text").join(sides, "conv_id").select("pair_id", "rejected", "turn", "role", "text")


def _head(turn: Column) -> Column:
    return F.concat(F.lit("<|"), turn["role"], F.lit("|>\n"))


def _rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t), t["text"], F.lit("\n"))), "")


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


BLOCK = 64


def _starts(sizes: Column) -> Column:
    """Sum of the sizes before each place, from sums of blocks: no array grows element by element."""
    total = lambda part: F.aggregate(part, F.lit(0), lambda s, n: s + n)
    sums = lambda n: F.transform(F.sequence(F.lit(0), F.floor(F.size(n) / BLOCK).cast("int")), lambda j: total(F.slice(n, j * BLOCK + 1, BLOCK)))
    block = lambda i: F.floor(i / BLOCK).cast("int")
    return _let(sizes, lambda n: _let(sums(n), lambda b: F.transform(n, lambda _, i: total(F.slice(b, 1, block(i))) + total(F.slice(n, block(i) * BLOCK + 1, i % BLOCK)))))


def _mask(turns: Column) -> Column:
    """start:end of each learnt text in the rendered turns, comma-joined."""
    places = F.zip_with(turns, _starts(F.transform(turns, lambda t: F.length(_head(t)) + F.length(t["text"]) + 1)), lambda t, at: F.struct(t["role"].alias("role"), (at + F.length(_head(t))).alias("at"), F.length(t["text"]).alias("n")))
    return F.array_join(F.transform(F.filter(places, lambda p: p["role"] == LEARNT), lambda p: F.concat_ws(":", p["at"], p["at"] + p["n"])), ",")


def format_pairs(turns: DataFrame) -> DataFrame:
    """pair_id, prompt, prompt_turns, chosen, rejected and their masks, from pair_id, rejected, turn, role, text."""
    text = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    both = turns.filter("pair_id is not null").groupBy("pair_id").agg(F.sort_array(F.collect_list(F.struct("rejected", "turn", text("role"), text("text")))).alias("all"))
    side = lambda flag: F.transform(F.filter("all", lambda t: t["rejected"] == flag), lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    sides = both.select("pair_id", side(False).alias("c"), side(True).alias("r"))
    differs = F.array_position(F.zip_with("c", "r", lambda a, b: a.eqNullSafe(b)), F.lit(False))
    sides = sides.withColumn("n", F.when(differs > 0, differs - 1).otherwise(F.size("c")).cast("int"))
    rest = lambda x: F.slice(x, F.col("n") + 1, F.greatest(F.size(x) - F.col("n"), F.lit(0)))
    return sides.select(
        "pair_id", F.col("n").alias("prompt_turns"), _rendered(F.slice("c", 1, F.col("n"))).alias("prompt"),
        _rendered(rest("c")).alias("chosen"), _mask(rest("c")).alias("chosen_mask"), _rendered(rest("r")).alias("rejected"), _mask(rest("r")).alias("rejected_mask"),
    )
