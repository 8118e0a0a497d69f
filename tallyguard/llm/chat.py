"""Preference formatting of conversations, in DataFrame operations.

A pair has a chosen and a rejected conversation. Their longest common prefix of turns is
rendered once as the prompt; what follows in either is a completion, with the spans of
characters that a loss may count: the assistant's words. Rendered turns look like
``<|role|>`` line break, text, line break.

Defined results: a null role or text counts as an empty one; rows without ``conv_id`` or
``turn`` belong to no conversation and are left out; equal rows count once, and different
rows with one turn number follow each other by role and text; a pair whose conversations
are equal has empty completions; a conversation missing from the turns is an empty one; an
empty table gives an empty result. Other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

ASSISTANT = "assistant"


def turns_of(conversations: DataFrame) -> DataFrame:
    """``conv_id`` and its ``turns`` in order, each with role and text."""
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).where("conv_id IS NOT NULL AND turn IS NOT NULL")
    # A conversation is one row of the result, so its turns have to meet.
    ordered = F.array_sort(F.collect_set(F.struct("turn", "role", "text")))
    return rows.groupBy("conv_id").agg(F.transform(ordered, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))


def stale_replies(turns: DataFrame) -> DataFrame:
    """Pairs made from one conversation: ``pair_id, chosen, rejected``.

    The rejected side gives, in place of its last reply, the first reply once more, or an
    empty one if both are the same.
    """
    turns = turns.where(F.exists("turns", lambda t: t["role"] == ASSISTANT))
    at = F.transform("turns", lambda t, i: F.when(t["role"] == ASSISTANT, i))
    last, first = F.array_max(at), F.array_min(at)
    stale = F.element_at("turns", first + 1)["text"]
    final = F.element_at("turns", last + 1)["text"]
    reply = F.when(stale == final, F.lit("")).otherwise(stale)
    rejected = F.transform("turns", lambda t, i: F.struct(t["role"].alias("role"), F.when(i == last, reply).otherwise(t["text"]).alias("text")))
    return turns.select(F.col("conv_id").alias("pair_id"), F.col("turns").alias("chosen"), rejected.alias("rejected"))


def pairs_of(turns: DataFrame, pairs: DataFrame) -> DataFrame:
    """``pair_id, chosen, rejected`` from conversations named by ``pairs(pair_id, chosen, rejected)``."""
    side = lambda name: turns.select(F.col("conv_id").alias(name), F.col("turns").alias(f"{name}_turns"))
    named = pairs.select("pair_id", F.col("chosen").cast("long"), F.col("rejected").cast("long"))
    joined = named.join(side("chosen"), "chosen", "left").join(side("rejected"), "rejected", "left")
    empty = F.expr("cast(array() as array<struct<role:string,text:string>>)")
    return joined.select("pair_id", F.coalesce("chosen_turns", empty).alias("chosen"), F.coalesce("rejected_turns", empty).alias("rejected"))


def _head(role: Column) -> Column:
    return F.concat(F.lit("<|"), role, F.lit("|>\n"))


def _rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t["role"]), t["text"], F.lit("\n"))), "")


def _spans(turns: str) -> str:
    """Start and end of the assistant's words in the rendered turns, as ``start-end,...``."""
    size = "length(t.role) + length(t.text) + 6"
    return f"""array_join(aggregate({turns},
        named_struct('at', 0L, 'spans', cast(array() as array<string>)),
        (s, t) -> named_struct('at', s.at + {size}, 'spans', if(t.role = '{ASSISTANT}',
            concat(s.spans, array(concat(s.at + length(t.role) + 5, '-', s.at + length(t.role) + 5 + length(t.text)))), s.spans)),
        s -> s.spans), ',')"""


def preference_rows(pairs: DataFrame) -> DataFrame:
    """``pair_id, n_prompt, prompt`` and for both sides the completion and its mask."""
    common = F.expr(
        """coalesce(
            array_min(transform(
                sequence(0, greatest(size(chosen), size(rejected))),
                i -> if(get(chosen, i) <=> get(rejected, i) AND i < least(size(chosen), size(rejected)), null, i))), 0)"""
    )
    cut = pairs.withColumn("n_prompt", common).select(
        "pair_id",
        "n_prompt",
        F.expr("slice(chosen, 1, n_prompt)").alias("head"),
        F.expr("slice(chosen, n_prompt + 1, size(chosen))").alias("chosen"),
        F.expr("slice(rejected, n_prompt + 1, size(rejected))").alias("rejected"),
    )
    return cut.select(
        "pair_id",
        "n_prompt",
        _rendered(F.col("head")).alias("prompt"),
        _rendered(F.col("chosen")).alias("chosen"),
        F.expr(_spans("chosen")).alias("chosen_mask"),
        _rendered(F.col("rejected")).alias("rejected"),
        F.expr(_spans("rejected")).alias("rejected_mask"),
    )
