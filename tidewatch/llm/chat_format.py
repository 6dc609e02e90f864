"""Preference formatting with native expressions: one prompt, two masked completions.

Each conversation's turns are put in order (turn, role, text).  The longest common prefix of turns of the chosen
and the rejected conversation is rendered once, as the prompt; what remains of each becomes a completion made of
segments, of which only the assistants' texts and their end marks are trained on.

Edge cases: rows with a null pair id belong to no pair and are left out; a null role or text renders as empty text,
and two nulls count as equal; repeated turns are kept; a pair with one side missing has that side's completion
empty and an empty prompt; equal conversations have two empty completions.  Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"


def _header(turn: Column) -> Column:
    return F.concat(F.lit(START), F.coalesce(turn["role"], F.lit("")), F.lit("\n"))


def _body(turn: Column) -> Column:
    return F.concat(F.coalesce(turn["text"], F.lit("")), F.lit(END))


def _segments(turns: Column) -> Column:
    """Header, body and line end of each turn, each with its training flag."""
    def one(turn: Column) -> Column:
        trained = F.coalesce(turn["role"] == "assistant", F.lit(False))
        return F.array(
            F.struct(_header(turn).alias("text"), F.lit(False).alias("train")),
            F.struct(_body(turn).alias("text"), trained.alias("train")),
            F.struct(F.lit("\n").alias("text"), F.lit(False).alias("train")),
        )
    return F.flatten(F.transform(turns, one))


def _turns(rows: DataFrame, key: str, turn: str, role: str, text: str, name: str) -> DataFrame:
    ordered = F.sort_array(F.collect_list(F.struct(
        F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"))))
    return rows.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("pair_id")).agg(ordered.alias(name))


def render(segments: Column) -> Column:
    return F.array_join(F.transform(segments, lambda s: s["text"]), "")


def mask(segments: Column) -> Column:
    """Lengths of the segments, trained ones marked by ``+``."""
    return F.array_join(F.transform(segments, lambda s: F.concat(
        F.when(s["train"], F.lit("+")).otherwise(F.lit("-")), F.length(s["text"]).cast("string"))), ",")


def format_preferences(chosen: DataFrame, rejected: DataFrame, key: str = "pair_id", turn: str = "turn",
                       role: str = "role", text: str = "text") -> DataFrame:
    """pair_id, n_prompt_turns, prompt, and per side its segments ``array<struct<text, train>>``.

    A conversation is one output record, so its turns are gathered by one aggregation per side; the two sides then
    meet on the same partitioning, without another exchange.
    """
    none = F.array().cast("array<struct<turn:bigint,role:string,text:string>>")
    pairs = _turns(chosen, key, turn, role, text, "_c").join(
        _turns(rejected, key, turn, role, text, "_r"), "pair_id", "full"
    ).select("pair_id", F.coalesce("_c", none).alias("_c"), F.coalesce("_r", none).alias("_r"))
    shorter = F.least(F.size("_c"), F.size("_r"))
    same = F.zip_with(F.slice("_c", 1, shorter), F.slice("_r", 1, shorter), lambda a, b: (
        a["role"].eqNullSafe(b["role"]) & a["text"].eqNullSafe(b["text"])))
    first_other = F.array_position(same, False).cast("int")
    pairs = pairs.withColumn("n_prompt_turns", F.when(first_other == 0, shorter).otherwise(first_other - 1))
    rest = lambda name: F.slice(name, F.col("n_prompt_turns") + 1, F.size(name))
    return pairs.select(
        "pair_id", "n_prompt_turns",
        render(_segments(F.slice("_c", 1, F.col("n_prompt_turns")))).alias("prompt"),
        _segments(rest("_c")).alias("chosen"), _segments(rest("_r")).alias("rejected"),
    )
