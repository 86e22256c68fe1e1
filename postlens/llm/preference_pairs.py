"""Preference formatting: one shared prompt and two masked completions.

The longest common turn prefix of a chosen and a rejected conversation is rendered once, as the
prompt; what follows in each is rendered as its completion. A completion's mask lists the spans of
characters that are trained on: the text and end mark of assistant turns. All of it is array
functions in one projection; nothing is shuffled but what builds the pairs.

Defined cases: a null role or text renders as empty; turns are equal if role and text are (nulls
equal nulls); a null or empty conversation has no turns; if one conversation is a prefix of the
other, its completion is empty; repeated rows and null ids pass through; an empty table gives an
empty result; an extra column named like an output is replaced; a very long text is rendered whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import written

FORMATTED = ("prompt_turns", "prompt", "chosen_text", "chosen_mask", "rejected_text", "rejected_mask")
TURN = "array<struct<role:string,text:string>>"


def rendered(turn: Column) -> Column:
    return F.concat(F.lit("<|"), F.coalesce(turn["role"], F.lit("")), F.lit("|>\n"), F.coalesce(turn["text"], F.lit("")), F.lit("<|end|>\n"))


def common_turns(a: Column, b: Column) -> Column:
    """The number of turns of the longest common prefix."""
    least = F.least(F.size(a), F.size(b))
    differs = F.filter(F.sequence(F.lit(1), least), lambda i: ~F.element_at(a, i).eqNullSafe(F.element_at(b, i)))
    return F.when(least <= 0, 0).otherwise(F.coalesce(F.array_min(differs) - 1, least))


def trained_spans(turns: Column) -> Column:
    """(start, end) in the rendering of ``turns`` of each assistant turn's text and end mark."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(held: Column, turn: Column) -> Column:
        end = held["at"] + F.length(rendered(turn))
        head = F.length(F.concat(F.lit("<|"), F.coalesce(turn["role"], F.lit("")), F.lit("|>\n")))
        span = F.array(F.struct((held["at"] + head).alias("start"), (end - 1).alias("end")))
        return F.struct(end.alias("at"), F.when(turn["role"] == "assistant", F.concat(held["spans"], span)).otherwise(held["spans"]).alias("spans"))

    return F.aggregate(turns, start, step, lambda held: held["spans"])


def format_pairs(pairs: DataFrame, chosen: str = "chosen", rejected: str = "rejected") -> DataFrame:
    """``pairs`` with ``chosen`` and ``rejected`` (arrays of (role, text)) replaced by prompt_turns,
    prompt, chosen_text, chosen_mask, rejected_text and rejected_mask. Other columns stay, but for those
    with the name of an output, which it replaces."""
    others = [c for c in pairs.columns if c not in (chosen, rejected, *FORMATTED)]
    none = F.array().cast(TURN)
    base = pairs.select(F.struct(*others).alias("row") if others else F.lit(0).alias("row"), F.coalesce(F.col(chosen).cast(TURN), none).alias("a"), F.coalesce(F.col(rejected).cast(TURN), none).alias("b"))
    base = base.withColumn("n", common_turns(F.col("a"), F.col("b")))
    rest = lambda x: F.slice(x, F.col("n") + 1, F.greatest(F.size(x) - F.col("n"), F.lit(0)))
    base = base.select("row", "n", F.slice("a", 1, F.col("n")).alias("p"), rest(F.col("a")).alias("a"), rest(F.col("b")).alias("b"))
    text = lambda turns: F.array_join(F.transform(turns, rendered), "")
    return base.select(
        *([F.col("row")[c].alias(c) for c in others]), F.col("n").alias("prompt_turns"), text(F.col("p")).alias("prompt"),
        text(F.col("a")).alias("chosen_text"), trained_spans(F.col("a")).alias("chosen_mask"),
        text(F.col("b")).alias("rejected_text"), trained_spans(F.col("b")).alias("rejected_mask"),
    )


def next_ids(ids: DataFrame) -> DataFrame:
    """(id, next): each id of the written, distinct ``ids`` (id) and the next one in order, the first one
    after the last. Ids are range-partitioned; a partition's last id takes the first of the next one."""
    placed = written(ids.repartitionByRange("id").withColumn("part", F.spark_partition_id()), "placed-ids")
    first = sorted(map(tuple, placed.groupBy("part").agg(F.min("id")).collect()))  # a row a partition
    after = [(part, first[(i + 1) % len(first)][1]) for i, (part, _) in enumerate(first)]
    begins = ids.sparkSession.createDataFrame(after, "part int, begin long")
    following = F.lead("id").over(Window.partitionBy("part").orderBy("id"))
    return placed.withColumn("following", following).join(F.broadcast(begins), "part").select("id", F.coalesce("following", "begin").alias("next"))


def conversation_pairs(turns: DataFrame) -> DataFrame:
    """(pair_id, answer_no, chosen, rejected) from ``turns`` (conv_id, turn, role, text), which holds no
    judgements: for each answer (assistant turn) of a conversation, the whole conversation is chosen,
    and the same with that answer replaced is rejected; the turns behind it stay. The answer in its
    place comes from the next conversation with an answer in id order (the first one after the last):
    its answer of the same number, counted round. Conversations without an id or an answer make no
    pair; the only one with an answer is paired with itself."""
    item = F.struct("turn", F.col("role").alias("role"), F.col("text").alias("text"))
    whole = turns.filter("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), item.alias("item"))
    whole = whole.groupBy("conv_id").agg(F.sort_array(F.collect_list("item")).alias("items"))
    plain = F.transform("items", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    places = F.filter(F.sequence(F.lit(1), F.size("items")), lambda i: F.element_at("items", i)["role"].eqNullSafe("assistant"))
    whole = written(whole.select("conv_id", plain.alias("chosen"), places.alias("places")).filter(F.size("places") > 0), "answered")
    answers = whole.select(F.col("conv_id").alias("next"), F.transform("places", lambda i: F.element_at("chosen", i)).alias("answers"))
    joined = whole.join(next_ids(whole.select(F.col("conv_id").alias("id"))), F.col("conv_id") == F.col("id")).join(answers, "next")
    each = joined.select("conv_id", "chosen", "answers", F.posexplode("places").alias("no", "place"))
    other = F.element_at("answers", F.col("no") % F.size("answers") + 1)
    rejected = F.transform("chosen", lambda t, i: F.when(i == F.col("place") - 1, other).otherwise(t))
    return each.select(F.col("conv_id").alias("pair_id"), (F.col("no") + 1).alias("answer_no"), "chosen", rejected.alias("rejected"))
