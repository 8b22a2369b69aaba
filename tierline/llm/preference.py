"""Preference pairs as training text.

Chosen and rejected conversations are compared turn by turn. The longest prefix of turns they share is
rendered once, as the prompt; the rest of each is rendered as a completion with a mask that says which
characters are trained on: the text and end mark of assistant turns. DataFrame functions only.

A mask is a run-length code, `<characters>:<0 or 1>` for each piece of the completion in order, so it
needs no position arithmetic and its lengths add up to the completion's.

Skew: conversations are grouped by id, and only a pair's own turns meet in a row.

Edge cases: turns come in the order (turn, role, text), NULLs first; NULL role or text renders as empty, and
NULL equals NULL; a turn repeated in full counts once; a pair that lacks one side has an empty completion
there and no prompt; pairs of identical conversations are all prompt with two empty completions; rows
without a pair id belong to no pair.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRAINED_ROLE = "assistant"


def header(turn: Column) -> Column:
    return F.concat(F.lit("<|"), F.coalesce(turn["role"], F.lit("")), F.lit("|>\n"))


def body(turn: Column) -> Column:
    return F.concat(F.coalesce(turn["text"], F.lit("")), F.lit("<|end|>\n"))


def rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(header(t), body(t))), "")


def mask(turns: Column) -> Column:
    """Run-length mask of the rendered turns."""

    def runs(turn: Column) -> Column:
        trained = F.when(turn["role"] == TRAINED_ROLE, F.lit("1")).otherwise(F.lit("0"))
        return F.concat(
            F.char_length(header(turn)), F.lit(":0,"), F.char_length(body(turn)), F.lit(":"), trained
        )

    return F.array_join(F.transform(turns, runs), ",")


def conversations(turns: DataFrame, pair_id: str = "pair_id") -> DataFrame:
    """A row per conversation: pair_id and its turns in order."""
    turn = F.struct(
        F.col("turn").cast("bigint").alias("turn"),
        F.col("role").cast("string").alias("role"),
        F.col("text").cast("string").alias("text"),
    )
    grouped = turns.where(F.col(pair_id).isNotNull()).groupBy(F.col(pair_id).alias("pair_id"))
    return grouped.agg(F.sort_array(F.collect_set(turn)).alias("turns"))


def shared_turns(left: Column, right: Column) -> Column:
    """Length of the longest common prefix of two turn lists (role and text count, numbers don't)."""
    same = F.zip_with(
        left, right, lambda a, b: a["role"].eqNullSafe(b["role"]) & a["text"].eqNullSafe(b["text"])
    )
    shorter = F.least(F.size(left), F.size(right))
    first_other = F.array_position(F.slice(same, F.lit(1), shorter), False)
    return F.when(first_other > 0, first_other - 1).otherwise(shorter).cast("int")


def format_preferences(chosen: DataFrame, rejected: DataFrame, pair_id: str = "pair_id") -> DataFrame:
    """A row per pair: pair_id, prompt, chosen, rejected, chosen_mask, rejected_mask, prompt_turns,
    chosen_turns, rejected_turns. Inputs have a row per turn: `pair_id`, turn, role, text."""
    none = F.array().cast("array<struct<turn:bigint,role:string,text:string>>")
    left = conversations(chosen, pair_id).withColumnRenamed("turns", "left")
    right = conversations(rejected, pair_id).withColumnRenamed("turns", "right")
    pairs = left.join(right, "pair_id", "full_outer").select(
        "pair_id", F.coalesce("left", none).alias("left"), F.coalesce("right", none).alias("right")
    )
    shared = pairs.withColumn("shared", shared_turns(F.col("left"), F.col("right")))

    def rest(side: str) -> Column:
        return F.slice(F.col(side), F.col("shared") + 1, F.size(side) - F.col("shared"))

    parts = shared.select(
        "pair_id",
        "shared",
        F.slice("left", F.lit(1), F.col("shared")).alias("prompt"),
        rest("left").alias("left"),
        rest("right").alias("right"),
    )
    return parts.select(
        "pair_id",
        rendered(F.col("prompt")).alias("prompt"),
        rendered(F.col("left")).alias("chosen"),
        rendered(F.col("right")).alias("rejected"),
        mask(F.col("left")).alias("chosen_mask"),
        mask(F.col("right")).alias("rejected_mask"),
        F.col("shared").cast("bigint").alias("prompt_turns"),
        F.size("left").cast("bigint").alias("chosen_turns"),
        F.size("right").cast("bigint").alias("rejected_turns"),
    )
