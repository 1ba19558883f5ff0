"""Preference formatting: the common turns of a pair once as prompt, the rest as masked completions.

Everything is built-in expressions on one row per pair; nothing is shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURNS = "array<struct<role:string,text:string>>"


@dataclass(frozen=True)
class Markup:
    """How a turn is written: ``before``, the role, ``between``, the text, ``after``."""

    before: str = "<|turn|>"
    between: str = "\n"
    after: str = "<|end|>\n"


def _written(turn: Column, markup: Markup) -> Column:
    return F.concat(
        F.lit(markup.before), F.coalesce(turn["role"], F.lit("")), F.lit(markup.between),
        F.coalesce(turn["text"], F.lit("")), F.lit(markup.after),
    )


def _rendered(turns: Column, markup: Markup) -> Column:
    return F.array_join(F.transform(turns, lambda turn: _written(turn, markup)), "")


def _trained_spans(turns: Column, markup: Markup, role: str) -> Column:
    """(start, end) in the rendered turns of what a loss should see: text and end mark of ``role``'s turns."""
    spans = F.array().cast("array<struct<start:long,end:long>>")
    start = F.struct(F.lit(0).cast("long").alias("at"), spans.alias("spans"))

    def step(state: Column, turn: Column) -> Column:
        opening = F.length(F.concat(F.lit(markup.before), F.coalesce(turn["role"], F.lit("")), F.lit(markup.between)))
        end = state["at"] + F.length(_written(turn, markup))
        span = F.struct((state["at"] + opening).cast("long").alias("start"), end.cast("long").alias("end"))
        return F.struct(
            end.cast("long").alias("at"),
            F.when(turn["role"] == role, F.concat(state["spans"], F.array(span))).otherwise(state["spans"]).alias("spans"),
        )

    return F.aggregate(turns, start, step, lambda state: state["spans"])


def common_turns(chosen: Column, rejected: Column) -> Column:
    """Length of the longest common prefix of two turn lists; a null role or text equals another null."""
    shorter = F.least(F.size(chosen), F.size(rejected))
    places = F.sequence(F.lit(1), shorter)
    same = F.transform(
        places, lambda i: F.element_at(chosen, i).eqNullSafe(F.element_at(rejected, i))
    )
    first_other = F.array_position(same, False).cast("int")
    return F.when(shorter == 0, 0).when(first_other == 0, shorter).otherwise(first_other - 1)


def format_preferences(
    pairs: DataFrame, key_cols: list[str], markup: Markup | None = None, trained_role: str = "assistant",
    chosen_col: str = "chosen", rejected_col: str = "rejected",
) -> DataFrame:
    """(keys, n_prompt_turns, prompt, chosen_text, rejected_text, chosen_spans, rejected_spans, usable).

    ``chosen`` and ``rejected`` are arrays of (role, text); null counts as empty. The prompt holds the
    longest common prefix of turns, written once; the completions hold the rest of each side. Spans
    are character offsets in a completion that a loss should see: text and end mark of each turn of
    ``trained_role``. A pair is usable when both completions have such a span; equal sides, empty
    sides and pairs where one side is the start of the other are returned with ``usable`` false.
    Repeated pairs are formatted each; other columns of ``pairs`` play no part.
    """
    markup = markup or Markup()
    empty = F.array().cast(TURNS)
    sides = pairs.select(
        *key_cols,
        F.coalesce(F.col(chosen_col).cast(TURNS), empty).alias("_chosen"),
        F.coalesce(F.col(rejected_col).cast(TURNS), empty).alias("_rejected"),
    ).withColumn("n_prompt_turns", common_turns(F.col("_chosen"), F.col("_rejected")))
    shared = F.col("n_prompt_turns")

    def rest(name: str) -> Column:
        return F.slice(F.col(name), shared + 1, F.greatest(F.size(name) - shared, F.lit(0)))

    cut = sides.select(
        *key_cols, "n_prompt_turns", F.slice(F.col("_chosen"), F.lit(1), shared).alias("_prompt"),
        rest("_chosen").alias("_chosen"), rest("_rejected").alias("_rejected"),
    )
    formatted = cut.select(
        *key_cols, "n_prompt_turns",
        _rendered(F.col("_prompt"), markup).alias("prompt"),
        _rendered(F.col("_chosen"), markup).alias("chosen_text"),
        _rendered(F.col("_rejected"), markup).alias("rejected_text"),
        _trained_spans(F.col("_chosen"), markup, trained_role).alias("chosen_spans"),
        _trained_spans(F.col("_rejected"), markup, trained_role).alias("rejected_spans"),
    )
    return formatted.withColumn("usable", (F.size("chosen_spans") > 0) & (F.size("rejected_spans") > 0))


def gather_turns(turns: DataFrame, key_col: str = "conv_id") -> DataFrame:
    """(key, turns): the turns of each conversation in order, one row per conversation.

    Ties in the turn number are put in order by role and text. A conversation is a record and held in
    one row. A turn without a key belongs to none: it is a conversation of its own, and needs no shuffle.
    """
    turn = F.struct("turn", "role", "text")
    ordered = F.array_sort(F.collect_list(turn))
    gathered = turns.filter(F.col(key_col).isNotNull()).groupBy(key_col).agg(
        F.transform(ordered, lambda each: F.struct(each["role"].alias("role"), each["text"].alias("text"))).alias("turns")
    )
    alone = F.array(F.struct("role", "text")).alias("turns")
    return gathered.unionByName(turns.filter(F.col(key_col).isNull()).select(key_col, alone))


def weakened_pairs(conversations: DataFrame, key_col: str = "conv_id", role: str = "assistant") -> DataFrame:
    """(key, chosen, rejected): preference pairs made of conversations alone.

    Chosen is the conversation up to its last reply; rejected has its first reply again in place of
    the last one, or an empty reply where there is no other. Without any reply both sides are equal.
    """
    turns = F.col("turns")
    last = F.size(turns) - F.array_position(F.reverse(F.transform(turns, lambda t: F.coalesce(t["role"] == role, F.lit(False)))), True) + 1
    replied = F.exists(turns, lambda t: F.coalesce(t["role"] == role, F.lit(False)))
    chosen = F.when(replied, F.slice(turns, F.lit(1), last.cast("int"))).otherwise(turns)
    first = F.filter("turns", lambda t: F.coalesce(t["role"] == role, F.lit(False)))[0]["text"]
    final = F.element_at("chosen", -1)["text"]
    other = F.when(first.eqNullSafe(final), F.lit("")).otherwise(F.coalesce(first, F.lit("")))
    reply = F.struct(F.lit(role).alias("role"), other.alias("text"))
    rejected = F.when(
        F.col("replied"), F.concat(F.slice("chosen", F.lit(1), F.size("chosen") - 1), F.array(reply))
    ).otherwise(F.col("chosen"))
    return (
        conversations.select(key_col, turns, chosen.cast(TURNS).alias("chosen"), replied.alias("replied"))
        .select(key_col, "chosen", rejected.cast(TURNS).alias("rejected"))
    )
