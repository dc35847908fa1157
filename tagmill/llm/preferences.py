"""Preference formatting: a chosen and a rejected conversation, rendered as one prompt and two completions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The marks of the widespread chat format that is rendered here.
OPEN, MIDDLE, CLOSE = "<|im_start|>", "\n", "<|im_end|>\n"


def rendered(turn: Column) -> Column:
    """A turn with its marks; a null role or text is empty."""
    role, text = (F.coalesce(turn[c], F.lit("")) for c in ("role", "text"))
    return F.concat(F.lit(OPEN), role, F.lit(MIDDLE), text, F.lit(CLOSE))


def common_turns(chosen: Column, rejected: Column) -> Column:
    """How many first turns two arrays of (role, text) share; nulls equal nulls."""
    shorter = F.least(F.size(chosen), F.size(rejected))
    places = F.when(shorter > 0, F.sequence(F.lit(0), shorter - 1)).otherwise(F.array().cast("array<int>"))
    same = F.transform(places, lambda i: _turn(chosen, i).eqNullSafe(_turn(rejected, i)))
    first = F.array_position(same, False)  # from 1; 0 if all are the same
    return F.when(first > 0, first - 1).otherwise(shorter).cast("int")


def _turn(turns: Column, i: Column) -> Column:
    return F.get(turns, i)


def completion(turns: Column, common: Column) -> Column:
    """The turns behind the common ones."""
    return F.slice(turns, common + 1, F.greatest(F.size(turns) - common, F.lit(0)))


def masked_spans(turns: Column) -> Column:
    """(begin, end) in characters of what a model is trained on: each assistant turn's text and closing mark. All else
    in the completion (headers, other roles) is masked, as is the prompt."""
    sizes = F.transform(turns, lambda t: F.length(rendered(t)))
    empty = F.array().cast("array<struct<begin:int,end:int>>")
    start = F.struct(F.lit(0).alias("at"), empty.alias("spans"))

    def step(state: Column, pair: Column) -> Column:
        turn, size = pair["turn"], pair["size"]
        head = F.length(F.concat(F.lit(OPEN), F.coalesce(turn["role"], F.lit("")), F.lit(MIDDLE)))
        span = F.struct((state["at"] + head).cast("int").alias("begin"), (state["at"] + size).cast("int").alias("end"))
        trained = turn["role"].eqNullSafe("assistant")
        spans = F.when(trained, F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct((state["at"] + size).cast("int").alias("at"), spans.alias("spans"))

    pairs = F.zip_with(turns, sizes, lambda t, n: F.struct(t.alias("turn"), n.alias("size")))
    return F.aggregate(pairs, start, step, lambda state: state["spans"])


def format_preferences(pairs: DataFrame, chosen: str = "chosen", rejected: str = "rejected") -> DataFrame:
    """Adds to pairs of conversations (arrays of struct(role, text)): common_turns, prompt, and for either side its
    text behind the prompt and its trained spans (chosen_text, chosen_spans, rejected_text, rejected_spans).

    The prompt is the longest common run of first turns, rendered once; a null conversation is empty. Conversations
    that are equal leave two empty completions.
    """
    empty = F.array().cast(pairs.schema[chosen].dataType)
    sides = {"chosen": F.coalesce(chosen, empty), "rejected": F.coalesce(rejected, empty)}
    out = pairs.withColumns({f"__{k}": v for k, v in sides.items()})
    out = out.withColumn("common_turns", common_turns(F.col("__chosen"), F.col("__rejected")))
    prompt = F.slice(F.col("__chosen"), F.lit(1), F.col("common_turns"))
    out = out.withColumn("prompt", F.array_join(F.transform(prompt, rendered), ""))
    for side in sides:
        rest = completion(F.col(f"__{side}"), F.col("common_turns"))
        out = out.withColumns(
            {f"{side}_text": F.array_join(F.transform(rest, rendered), ""), f"{side}_spans": masked_spans(rest)}
        )
    return out.drop(*(f"__{side}" for side in sides))


def conversation_turns(turns: DataFrame, key: str = "conv_id", order: str = "turn") -> DataFrame:
    """(``key``, turns): each conversation as one array of (role, text) in order; ties go by role and text.

    A conversation is one record of the output, so its turns meet in one row. Null keys are one conversation.
    """
    rows = F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), "role", "text")))
    listed = turns.groupBy(key).agg(rows.alias("turns"))
    return listed.withColumn("turns", F.transform("turns", lambda t: F.struct(t["role"], t["text"])))


def swapped_last_answers(conversations: DataFrame, key: str = "conv_id") -> DataFrame:
    """(``key``, chosen, rejected): each conversation beside itself with the last assistant turn of its neighbour.

    Neighbours are conversations 2 k and 2 k + 1. What follows the answer is dropped on both sides. A conversation
    without a neighbour that answers is beside itself without its last answer; one without an answer of
    its own beside itself. Null keys have no neighbour.
    """
    answers = F.filter(F.sequence(F.lit(1), F.greatest(F.size("turns"), F.lit(1))), lambda i: F.get("turns", i - 1)["role"] == "assistant")
    rows = conversations.select(key, "turns", F.array_max(answers).alias("last"))
    other = rows.select(
        F.expr(f"{key} ^ 1").alias("__key"), F.get("turns", F.col("last") - 1).alias("__answer")
    )
    both = rows.join(other.where(F.col("__key").isNotNull()), F.col(key) == F.col("__key"), "left")
    before = F.slice("turns", F.lit(1), F.col("last") - 1)
    swapped = F.when(F.col("__answer").isNull(), before).otherwise(F.concat(before, F.array("__answer")))
    upto = F.slice("turns", F.lit(1), F.col("last"))
    return both.select(
        key,
        F.when(F.col("last").isNull(), F.col("turns")).otherwise(upto).alias("chosen"),
        F.when(F.col("last").isNull(), F.col("turns")).otherwise(swapped).alias("rejected"),
    )
