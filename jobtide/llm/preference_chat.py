"""Preference pairs for chat models: the turns that both conversations share become the prompt, the rest two completions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: How a turn is written. The answer's own words and its close are learned; its head is not.
OPEN, MIDDLE, CLOSE = "<|im_start|>", "\n", "<|im_end|>\n"
LEARNED_ROLE = "assistant"


def _head(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), turn["role"], F.lit(MIDDLE))


def _body(turn: Column) -> Column:
    return F.concat(turn["text"], F.lit(CLOSE))


def _rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t), _body(t))), "")


def _mask(turns: Column) -> Column:
    """start:end of every learned stretch of the rendered turns, in code points, comma-joined."""
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("spans"))

    def step(state: Column, turn: Column) -> Column:
        start = state["at"] + F.length(_head(turn))
        end = start + F.length(_body(turn))
        span = F.concat_ws(":", start.cast("string"), end.cast("string"))
        return F.struct(end.alias("at"), F.when(turn["role"] == LEARNED_ROLE, F.concat(state["spans"], F.array(span))).otherwise(state["spans"]).alias("spans"))

    return F.aggregate(turns, zero, step, lambda state: F.array_join(state["spans"], ","))


def preference_pairs(chosen: DataFrame, rejected: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per key that is in either table: ``pair_id``, ``shared_turns``, ``prompt``, ``chosen``, ``rejected``, ``chosen_mask``, ``rejected_mask``.

    Turns are matched by number. The shared prefix ends before the first number whose role or text differs or that one
    side lacks; it is found by a join of the turns and a minimum per pair, so long conversations are never compared in one
    task. Rendering gathers the turns of one pair, since its result is one text. Null roles and texts are empty. A turn
    with a null key or number is left out. Turns that repeat a number are taken in order of role and text. Other columns
    are ignored; a side without turns is an empty completion; empty tables give no rows.
    """

    def turns(df: DataFrame, side: str) -> DataFrame:
        plain = df.select(F.col(f"`{key}`").alias("pair_id"), F.col(f"`{turn}`").alias("turn"), F.coalesce(F.col(f"`{role}`").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
        return plain.where("pair_id IS NOT NULL AND turn IS NOT NULL").groupBy("pair_id", "turn").agg(F.sort_array(F.collect_list(F.struct("role", "text"))).alias(side))

    both = turns(chosen, "c").join(turns(rejected, "r"), ["pair_id", "turn"], "full")
    marked = both.withColumn("same", F.col("c").eqNullSafe(F.col("r")))
    gathered = marked.groupBy("pair_id").agg(
        F.min(F.when(~F.col("same"), F.col("turn"))).alias("split"),
        F.sort_array(F.collect_list(F.struct("turn", "c", "r"))).alias("turns"),
    )

    def side(name: str, before: bool) -> Column:
        split = F.col("split")
        chosen_turns = F.filter("turns", lambda t: (split.isNull() | (t["turn"] < split)) if before else (t["turn"] >= split))
        return F.flatten(F.filter(F.transform(chosen_turns, lambda t: t[name]), lambda t: t.isNotNull()))

    empty = F.array().cast("array<struct<role:string,text:string>>")
    parts = gathered.select("pair_id", side("c", True).alias("p"), F.coalesce(side("c", False), empty).alias("c"), F.coalesce(side("r", False), empty).alias("r"))
    return parts.select("pair_id", F.size("p").cast("long").alias("shared_turns"), _rendered(F.col("p")).alias("prompt"), _rendered(F.col("c")).alias("chosen"), _rendered(F.col("r")).alias("rejected"), _mask(F.col("c")).alias("chosen_mask"), _mask(F.col("r")).alias("rejected_mask"))
