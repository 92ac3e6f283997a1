"""Preference formatting: one shared prompt and a pair of masked completions.

For each pair of a chosen and a rejected conversation the longest common prefix of
turns is found and rendered once as prompt; what follows is rendered once per side.
Every turn is one row of the result, in order, with a mask that says which characters
to train on. Work is by turn throughout: a conversation of any length is many rows
and never one value, and no step needs the turns of one conversation in one task.
``assemble`` joins the pieces to one row per pair where conversations are short.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weathermart.llm.common import text_or_empty

TRAINED_ROLE = "assistant"
START, END = "<|im_start|>", "<|im_end|>"


def header(role: Column) -> Column:
    return F.concat(F.lit(START), F.coalesce(role, F.lit("")), F.lit("\n"))


def rendered(role: Column, text: Column) -> Column:
    return F.concat(header(role), text_or_empty(text), F.lit(END + "\n"))


def turn_table(conversations: DataFrame) -> DataFrame:
    """conv_id, turn and what is said there: distinct (role, text), sorted.

    Repeated rows count once. Several rows with one turn number make one turn. Rows
    without conv_id belong to no conversation; a null turn is one before all others.
    """
    said = F.struct("role", "text")
    return (
        conversations.where(F.col("conv_id").isNotNull())
        .select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text")
        .distinct()
        .groupBy("conv_id", "turn")
        .agg(F.sort_array(F.collect_list(said)).alias("said"))
        .withColumn("turn", F.coalesce("turn", F.lit(-(2**62))))
    )


def common_prefix(pairs: DataFrame, turns: DataFrame) -> DataFrame:
    """pair_id and ``split``: the first turn at which its conversations differ (null: none).

    The two sides meet turn by turn on (pair, turn), so long conversations spread over
    many tasks, and the earliest difference is a minimum taken inside each task first.
    """
    sides = _sides(pairs, turns)
    # Two equal sides make a turn that both have; anything else is a difference.
    met = sides.groupBy("pair_id", "turn").agg(
        F.count("*").alias("n"),
        F.min(F.xxhash64("said")).alias("low"),
        F.max(F.xxhash64("said")).alias("high"),
    )
    same = (F.col("n") == 2) & (F.col("low") == F.col("high"))
    return met.groupBy("pair_id").agg(F.min(F.when(~same, F.col("turn"))).alias("split"))


def _sides(pairs: DataFrame, turns: DataFrame) -> DataFrame:
    """Every turn of both conversations of every pair: pair_id, side, turn, said."""
    ids = pairs.select(
        "pair_id",
        F.inline(
            F.array(
                F.struct(F.lit("chosen").alias("side"), F.col("chosen").alias("conv_id")),
                F.struct(F.lit("rejected").alias("side"), F.col("rejected").alias("conv_id")),
            )
        ),
    )
    return ids.join(turns, "conv_id").select("pair_id", "side", "turn", "said")


def format_pairs(pairs: DataFrame, conversations: DataFrame) -> DataFrame:
    """Rendered pieces of every pair in ``pairs`` (pair_id, chosen, rejected).

    ``conversations`` has conv_id, turn, role and text. Columns: pair_id, part
    ("prompt", once per pair; "chosen" and "rejected"), turn, nth (rows within a turn),
    role, piece (the rendered text), train_from and train_to (characters of the piece
    to train on; equal where none are: the whole prompt, and turns of other roles).

    A pair whose conversations are equal has a prompt only. A side without rows has no
    completion. Null texts and roles render as empty. Empty tables give no rows. Other
    columns are ignored, whatever their names.
    """
    turns = turn_table(conversations)
    sides = _sides(pairs, turns).join(common_prefix(pairs, turns), "pair_id")
    shared = F.col("split").isNull() | (F.col("turn") < F.col("split"))
    pieces = (
        sides.withColumn("part", F.when(shared, F.lit("prompt")).otherwise(F.col("side")))
        .where((F.col("part") != "prompt") | (F.col("side") == "chosen"))
        .select("pair_id", "part", "turn", F.posexplode("said").alias("nth", "one"))
        .select("pair_id", "part", "turn", "nth", "one.role", "one.text")
    )
    trained = (F.col("part") != "prompt") & F.coalesce(F.col("role") == TRAINED_ROLE, F.lit(False))
    return pieces.select(
        "pair_id",
        "part",
        F.when(F.col("turn") > -(2**62), F.col("turn")).alias("turn"),
        "nth",
        "role",
        rendered(F.col("role"), F.col("text")).alias("piece"),
        F.when(trained, F.length(header(F.col("role")))).otherwise(0).alias("train_from"),
        F.when(
            trained,
            F.length(header(F.col("role"))) + F.length(text_or_empty(F.col("text"))) + len(END),
        )
        .otherwise(0)
        .alias("train_to"),
    )


def assemble(pieces: DataFrame) -> DataFrame:
    """One row per pair: prompt, chosen, rejected, each a string; masks as (from, to) spans.

    For conversations that fit one value; the pieces of a pair meet in one row.
    """
    spans = F.struct("turn", "nth", "piece", "train_from", "train_to")
    parts = pieces.groupBy("pair_id", "part").agg(F.sort_array(F.collect_list(spans)).alias("p"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<a:int,b:int>>").alias("m"))
    masks = F.aggregate(
        "p",
        start,
        lambda acc, x: F.struct(
            (acc["at"] + F.length(x["piece"])).alias("at"),
            F.when(
                x["train_to"] > x["train_from"],
                F.concat(
                    acc["m"],
                    F.array(
                        F.struct(
                            (acc["at"] + x["train_from"]).alias("a"),
                            (acc["at"] + x["train_to"]).alias("b"),
                        )
                    ),
                ),
            )
            .otherwise(acc["m"])
            .alias("m"),
        ),
        lambda acc: acc["m"],
    )
    text = F.array_join(F.transform("p", lambda x: x["piece"]), "")
    one = parts.select("pair_id", "part", text.alias("text"), masks.alias("mask"))

    def of(part: str, column: str) -> Column:
        return F.max(F.when(F.col("part") == part, F.col(column)))

    return one.groupBy("pair_id").agg(
        F.coalesce(of("prompt", "text"), F.lit("")).alias("prompt"),
        F.coalesce(of("chosen", "text"), F.lit("")).alias("chosen"),
        of("chosen", "mask").alias("chosen_mask"),
        F.coalesce(of("rejected", "text"), F.lit("")).alias("rejected"),
        of("rejected", "mask").alias("rejected_mask"),
    )


def swapped_pairs(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Preference data where a table holds single conversations only.

    The rejected side of a conversation is the same one with its last assistant turn
    answered by the text of the next conversation's last assistant turn (in conv_id
    order within ranges of 1,000 ids; the last of a range takes the range's first).
    A conversation without an assistant turn has nothing to swap: both sides are equal.
    Of several assistant rows in the last turn the greatest text is the answer, and that
    alone is replaced. Rows without conv_id are left out; any other id will do.
    Returns pairs and the conversations of both sides, whose ids are texts: the id itself,
    and ``<id>/swapped``.
    """
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text"
    )
    last = (
        rows.where(F.col("role") == TRAINED_ROLE)
        .groupBy("conv_id")
        .agg(F.max(F.struct("turn", "text")).alias("m"))
        .select("conv_id", F.col("m.turn").alias("last"), F.col("m.text").alias("answer"))
    )
    span = Window.partitionBy(F.floor(F.col("conv_id") / 1000))
    following = F.coalesce(
        F.lead("answer").over(span.orderBy("conv_id")),
        F.first("answer").over(span.orderBy("conv_id")),
    )
    swaps = (
        rows.select("conv_id").distinct().join(last.withColumn("other", following), "conv_id", "left")
    )
    own = F.col("conv_id").cast("string")
    swapped = F.concat(own, F.lit("/swapped"))
    pairs = swaps.select(
        F.col("conv_id").alias("pair_id"), own.alias("chosen"), swapped.alias("rejected")
    )
    is_answer = (
        (F.col("role") == TRAINED_ROLE)
        & F.col("turn").eqNullSafe(F.col("last"))
        & F.col("text").eqNullSafe(F.col("answer"))
    )
    other = rows.join(swaps, "conv_id").select(
        swapped.alias("conv_id"),
        "turn",
        "role",
        F.when(is_answer, F.col("other")).otherwise(F.col("text")).alias("text"),
    )
    return pairs, rows.withColumn("conv_id", own).unionAll(other)
