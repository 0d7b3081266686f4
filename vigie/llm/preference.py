"""Preference formatting of pairs of conversations.

The chosen and the rejected conversation of a pair share turns at their start. These are the prompt
and are rendered once; what follows in each is a completion, whose assistant turns are what a
model learns from. Turns stay rows: a conversation of any length is never gathered in one place.

Pairs come from outside (``format_pairs``), or a conversation is set against itself with another
answer at its end (``with_other_answer``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "<|turn|>", "<|end|>"
LEARNED_ROLES = ("assistant",)
SIDES = ("chosen", "rejected")


def neighbours(turns: DataFrame) -> DataFrame:
    """Pairs of conversations 2k (chosen) and 2k + 1 (rejected): ``pair_id, conv_id, chosen``."""
    return turns.select("conv_id").where("conv_id IS NOT NULL").distinct().select(
        F.floor(F.col("conv_id") / 2).cast("long").alias("pair_id"), "conv_id", (F.pmod("conv_id", F.lit(2)) == 0).alias("chosen"))


def rendered(role: Column, text: Column) -> Column:
    """A turn as text; control marks inside the turn are broken up so that they cannot end it."""
    plain = F.coalesce(text, F.lit(""))
    for mark in (OPEN, CLOSE):
        plain = F.replace(plain, F.lit(mark), F.lit(mark.replace("|", "| ", 1)))
    return F.concat(F.lit(OPEN), F.coalesce(role, F.lit("")), F.lit("\n"), plain, F.lit(CLOSE), F.lit("\n"))


def _spoken(turns: DataFrame) -> DataFrame:
    return turns.where("conv_id IS NOT NULL AND turn IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def with_other_answer(turns: DataFrame) -> DataFrame:
    """Sides of pairs, ``pair_id, chosen, turn, role, text``: a conversation up to its last answer, and
    the same with the last answer of conversation ``conv_id + 1`` instead.

    The pair has the conversation's number. The last answer is the turn of the highest number in a
    learned role; of several turns with that number, all are chosen and the last by role and text is
    replaced. Conversations without an answer, and those whose next one has none, are in no pair.
    """
    said = _spoken(turns)
    answers = said.where(F.lower("role").isin(*LEARNED_ROLES)).groupBy("conv_id").agg(F.max(F.struct("turn", "role", "text")).alias("own"))
    other = answers.select((F.col("conv_id") - 1).alias("conv_id"), F.col("own.role").alias("role"), F.col("own.text").alias("text"))
    ends = answers.select("conv_id", F.col("own.turn").alias("ends_at"))
    paired = ends.join(other, "conv_id")
    begun = said.join(paired.select("conv_id", "ends_at"), "conv_id").where("turn <= ends_at")
    sides = F.when(F.col("turn") < F.col("ends_at"), F.array(F.lit(True), F.lit(False))).otherwise(F.array(F.lit(True)))
    own = begun.select(F.col("conv_id").alias("pair_id"), F.explode(sides).alias("chosen"), "turn", "role", "text")
    return own.union(paired.select("conv_id", F.lit(False), "ends_at", "role", "text"))


def format_pairs(turns: DataFrame, pairs: DataFrame) -> DataFrame:
    """:func:`format_sides` of ``pairs`` of conversations, ``pair_id, conv_id, chosen``."""
    said = pairs.select("pair_id", "conv_id", "chosen").distinct().join(_spoken(turns), "conv_id")
    return format_sides(said.select("pair_id", "chosen", "turn", "role", "text"))


def format_sides(said: DataFrame) -> DataFrame:
    """``pair_id, part, turn, role, rendered, learned, learn_from, learn_to``: a row for each rendered turn.

    ``said`` has the turns of both sides, ``pair_id, chosen, turn, role, text``. ``part`` is ``prompt``
    for the longest common prefix of turns, and ``chosen`` or ``rejected`` for the completions.
    ``learned`` marks turns that count in training, and characters ``learn_from`` (included) to
    ``learn_to`` (excluded) of ``rendered`` are their mask: what is said and the end mark; 0 and 0
    elsewhere. Turns are compared by number, role and text (null as empty); turns of one number are
    ordered by role and text, and exact repetitions of a turn count once. Rows without a conversation
    or turn number are left out, and so are pairs with one side only. A side that ends with the prompt
    has one row without turn and role, with an empty text, as its completion: every pair has both.
    """
    # One row for each distinct turn, with the sides that say it.
    turn_rows = said.groupBy("pair_id", "turn", "role", "text").agg(F.max("chosen").alias("in_chosen"), F.max(~F.col("chosen")).alias("in_rejected"))
    pairs = turn_rows.groupBy("pair_id").agg(
        F.min(F.when(F.col("in_chosen") != F.col("in_rejected"), F.col("turn"))).alias("differs_at"),
        F.max(F.when(F.col("in_chosen"), F.col("turn"))).alias("chosen_to"),
        F.max(F.when(F.col("in_rejected"), F.col("turn"))).alias("rejected_to"),
    ).where("chosen_to IS NOT NULL AND rejected_to IS NOT NULL")
    both = turn_rows.join(pairs, "pair_id")
    in_prompt = F.col("differs_at").isNull() | (F.col("turn") < F.col("differs_at"))
    sides = F.when(in_prompt, F.array(F.lit("prompt"))).otherwise(_named(F.col("in_chosen"), F.col("in_rejected")))
    learned = F.lower("role").isin(*LEARNED_ROLES) & (F.col("part") != "prompt")
    shown = both.withColumn("part", F.explode(sides)).select(
        "pair_id", "part", "turn", "role", rendered(F.col("role"), F.col("text")).alias("rendered"), learned.alias("learned"))
    shown = shown.select(
        "*", F.when(F.col("learned"), F.char_length("role") + len(OPEN) + 1).otherwise(0).cast("long").alias("learn_from"),
        F.when(F.col("learned"), F.char_length("rendered") - 1).otherwise(0).cast("long").alias("learn_to"))
    # a side is over if all its turns are in the prompt
    over = [F.col("differs_at").isNull() | (F.col(f"{side}_to") < F.col("differs_at")) for side in SIDES]
    silent = pairs.withColumn("part", F.explode(_named(*over))).select(
        "pair_id", "part", F.lit(None).cast("long"), F.lit(None).cast("string"), F.lit(""), F.lit(False), F.lit(0).cast("long"), F.lit(0).cast("long"))
    return shown.union(silent)


def _named(chosen: Column, rejected: Column) -> Column:
    """Names of the sides that a condition holds for."""
    return F.filter(F.array(*(F.when(held, F.lit(side)) for held, side in zip((chosen, rejected), SIDES))), lambda s: s.isNotNull())
