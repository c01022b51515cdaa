"""Preference pairs: a shared prompt and two completions with masks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the rendering.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def _safe(text: Column) -> Column:
    """Text in which no mark of the rendering can occur."""
    return F.replace(F.coalesce(text, F.lit("")), F.lit("<|"), F.lit("< |"))


def _head(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), _safe(turn["role"]), F.lit("\n"))


def _body(turn: Column) -> Column:
    return F.concat(_safe(turn["text"]), F.lit(CLOSE + "\n"))


def _rendered(turns: Column) -> Column:
    return F.concat_ws("", F.transform(turns, lambda t: F.concat(_head(t), _body(t))))


def _mask(turns: Column) -> Column:
    """``start:end`` of what the assistant says in the rendered turns, its end mark included."""
    begun = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("spans"))

    def step(held: Column, t: Column) -> Column:
        start = held["at"] + F.length(_head(t))
        end = start + F.length(_body(t))
        span = F.concat_ws(":", start.cast("string"), (end - 1).cast("string"))
        return F.struct(
            end.alias("at"),
            F.when(t["role"] == "assistant", F.concat(held["spans"], F.array(span)))
            .otherwise(held["spans"])
            .alias("spans"),
        )

    return F.concat_ws(",", F.aggregate(turns, begun, step)["spans"])


def preference_pairs(pairs: DataFrame) -> DataFrame:
    """``pairs`` (chosen, rejected: arrays of role, text) as a prompt and two completions.

    Adds n_prompt_turns, prompt, chosen_completion, rejected_completion, chosen_mask and
    rejected_mask. The prompt is the longest common prefix of turns, rendered once; turns are
    common if role and text are equal, nulls being equal to each other. Masks name the code points
    of assistant turns in each completion, end exclusive.

    A null conversation counts as empty; equal conversations give empty completions. Null roles
    and texts render as empty. The text ``<|`` is broken up, so no turn can forge a mark. Rows
    that repeat stay; other columns are kept, those with the names above replaced.
    """
    empty = F.array().cast("array<struct<role:string,text:string>>")
    chosen, rejected = (F.coalesce(F.col(c).cast(empty_type), empty) for c, empty_type in (
        ("chosen", "array<struct<role:string,text:string>>"),
        ("rejected", "array<struct<role:string,text:string>>"),
    ))
    both = F.least(F.size(chosen), F.size(rejected))
    same = F.zip_with(
        F.slice(chosen, F.lit(1), both), F.slice(rejected, F.lit(1), both),
        lambda x, y: x["role"].eqNullSafe(y["role"]) & x["text"].eqNullSafe(y["text"]),
    )
    differs = F.array_position(same, F.lit(False))
    n = F.when(differs > 0, differs - 1).otherwise(both).cast("int")

    def rest(turns: Column) -> Column:
        return F.slice(turns, n + 1, F.size(turns))

    return pairs.withColumns(
        {
            "n_prompt_turns": n,
            "prompt": _rendered(F.slice(chosen, F.lit(1), n)),
            "chosen_completion": _rendered(rest(chosen)),
            "rejected_completion": _rendered(rest(rejected)),
            "chosen_mask": _mask(rest(chosen)),
            "rejected_mask": _mask(rest(rejected)),
        }
    )


def turns_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): the turns of each conversation by turn number.

    Turns that repeat a number are ordered by role and text; a null number comes first. A
    conversation is one row of the result, so its turns meet in one task by definition. A turn
    without an id is a conversation of its own.
    """
    turn = F.struct("turn", "role", "text")
    alone = F.when(F.col("conv_id").isNull(), F.monotonically_increasing_id()).alias("__alone")
    return conversations.select("conv_id", "turn", "role", "text", alone).groupBy("conv_id", "__alone").agg(
        F.transform(
            F.sort_array(F.collect_list(turn)), lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))
        ).alias("turns")
    ).drop("__alone")


def with_swapped_reply(conversations: DataFrame) -> DataFrame:
    """(conv_id, chosen, rejected): each conversation, and the same with another one's last reply.

    Conversations with ids 2k and 2k + 1 lend each other the last assistant turn. Without such a
    turn on either side, the rejected conversation just lacks its own. Turns without an id are
    conversations of one turn without a partner, and do not go through the join.
    """
    turns = turns_of(conversations.where("conv_id is not null"))
    single = turns_of(conversations.where("conv_id is null"))
    numbered = F.transform("turns", lambda t, k: F.when(t["role"] == "assistant", k))
    last = F.array_max(F.filter(numbered, lambda k: k.isNotNull()))
    own, single = (
        df.withColumn("last", last).withColumn("reply", F.get("turns", F.col("last"))) for df in (turns, single)
    )
    partner = own.select(F.col("conv_id").bitwiseXOR(F.lit(1)).alias("conv_id"), F.col("reply").alias("other"))
    before = F.when(F.col("last").isNull(), F.col("turns")).otherwise(F.slice("turns", F.lit(1), F.col("last")))
    after = F.when(F.col("last").isNotNull(), F.slice("turns", F.col("last") + 2, F.size("turns")))
    none = F.array().cast("array<struct<role:string,text:string>>")
    lent = F.when(F.col("last").isNotNull() & F.col("other").isNotNull(), F.array("other"))
    both = own.join(partner, "conv_id", "left").unionByName(
        single.withColumn("other", F.lit(None).cast("struct<role:string,text:string>"))
    )
    return both.select(
        "conv_id",
        F.col("turns").alias("chosen"),
        F.concat(before, F.coalesce(lent, none), F.coalesce(after, none)).alias("rejected"),
    )
