"""Preference data from conversations: one prompt, two masked completions. DataFrame functions only.

The prompt of a pair is the longest run of leading turns that the chosen and the rejected
conversation share, rendered once. What follows on either side is a completion; its mask lists the
character ranges of assistant texts, the only ones to train on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The marks of the chat format.
OPEN, MIDDLE, CLOSE = "<|", "|>\n", "<|end|>\n"


def turns_of(conversations: DataFrame) -> DataFrame:
    """One row per conversation: ``conv_id, turns`` (array of turn, role, text in order).

    Repeated rows count once. Turns that share a number are ordered by role and text; a null number
    comes first. Null roles and texts stay null here.
    """
    turn = F.struct("turn", "role", "text")
    return conversations.groupBy("conv_id").agg(F.array_sort(F.collect_set(turn)).alias("turns"))


def _render(turn: Column) -> Column:
    role, text = F.coalesce(turn["role"], F.lit("")), F.coalesce(turn["text"], F.lit(""))
    return F.concat(F.lit(OPEN), role, F.lit(MIDDLE), text, F.lit(CLOSE))


def _rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, _render), "")


def _spans(turns: Column) -> Column:
    """Character ranges [start, end) of assistant texts in the rendered turns."""
    start = F.struct(
        F.lit(0).cast("long").alias("at"),
        F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans"),
    )

    def add(state: Column, turn: Column) -> Column:
        head = F.length(F.coalesce(turn["role"], F.lit(""))) + len(OPEN) + len(MIDDLE)
        body = F.length(F.coalesce(turn["text"], F.lit("")))
        begin = state["at"] + head
        span = F.struct(begin.cast("long").alias("start"), (begin + body).cast("long").alias("end"))
        return F.struct(
            (begin + body + len(CLOSE)).cast("long").alias("at"),
            F.when(turn["role"] == "assistant", F.array_append(state["spans"], span))
            .otherwise(state["spans"])
            .alias("spans"),
        )

    return F.aggregate(turns, start, add, lambda state: state["spans"])


def format_pairs(pairs: DataFrame) -> DataFrame:
    """``pairs`` with ``n_prompt_turns, prompt, chosen, rejected, chosen_mask, rejected_mask``.

    ``pairs`` has arrays ``chosen`` and ``rejected`` of structs with ``role`` and ``text``; both are
    replaced by the rendered completions. Turns are equal if role and text are, null equal to null.
    Null arrays are empty conversations. Equal conversations give a full prompt and two empty
    completions; a conversation that is a prefix of the other gives an empty completion. Every row
    stays, repeated ones too; other columns stay unless named like a new one. A pair is one row
    throughout: rows are not moved.
    """
    new = ["n_prompt_turns", "prompt", "chosen", "rejected", "chosen_mask", "rejected_mask"]
    empty = lambda c: F.coalesce(F.transform(c, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))), F.array().cast("array<struct<role:string,text:string>>"))  # noqa: E731, E501
    good, bad = F.col("__good"), F.col("__bad")
    differs = F.zip_with(
        good,
        bad,
        lambda a, b: a.isNull() | b.isNull() | ~(a["role"].eqNullSafe(b["role"]) & a["text"].eqNullSafe(b["text"])),
    )
    first = F.array_position(differs, F.lit(True))
    shared = F.when(first > 0, first - 1).otherwise(F.size(good)).cast("int")
    rest = lambda c: F.slice(c, F.col("n_prompt_turns") + 1, F.size(c))
    return (
        pairs.withColumn("__good", empty(F.col("chosen")))
        .withColumn("__bad", empty(F.col("rejected")))
        .withColumn("n_prompt_turns", shared)
        .withColumn("__good_rest", rest(good))
        .withColumn("__bad_rest", rest(bad))
        .select(
            *[F.col(f"`{c}`") for c in pairs.columns if c not in new],
            "n_prompt_turns",
            _rendered(F.slice(good, F.lit(1), F.col("n_prompt_turns"))).alias("prompt"),
            _rendered(F.col("__good_rest")).alias("chosen"),
            _rendered(F.col("__bad_rest")).alias("rejected"),
            _spans(F.col("__good_rest")).alias("chosen_mask"),
            _spans(F.col("__bad_rest")).alias("rejected_mask"),
        )
    )


def last_answer_pairs(conversations: DataFrame) -> DataFrame:
    """Pairs ``conv_id, chosen, rejected`` from single conversations.

    Chosen is the conversation up to its last assistant turn, rejected the same with that answer
    replaced by the assistant's answer before, or by the opening turn where there is none. A
    conversation without an assistant turn is paired with itself.
    """
    turns = F.col("turns")
    spoken = F.filter(turns, lambda t: t["role"] == "assistant")
    n = F.size(turns)
    back = F.array_position(F.transform(F.reverse(turns), lambda t: F.coalesce(t["role"] == "assistant", F.lit(False))), F.lit(True))
    upto = F.when(back > 0, n - back + 1).otherwise(n).cast("int")
    other = F.when(F.size(spoken) > 1, F.element_at(spoken, -2)["text"]).otherwise(turns[0]["text"])
    last = F.element_at(F.col("chosen"), -1)
    swapped = F.array(F.struct(last["turn"].alias("turn"), last["role"].alias("role"), F.col("other").alias("text")))
    return (
        turns_of(conversations)
        .withColumn("back", back)
        .withColumn("other", F.when(F.size(spoken) > 1, other).otherwise(turns[0]["text"]))
        .withColumn("chosen", F.slice(turns, F.lit(1), upto))
        .select(
            "conv_id",
            "chosen",
            F.when(
                F.col("back") > 0, F.concat(F.slice("chosen", F.lit(1), F.size("chosen") - 1), swapped)
            )
            .otherwise(F.col("chosen"))
            .alias("rejected"),
        )
    )
