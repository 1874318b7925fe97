"""Chat formatting of logged conversations, without those that were logged again when they were longer.

A log holds a conversation once per snapshot: after two turns, after four, and so on. The rolling hash of the first k
turns is the sum of two 64-bit hashes of (place, role, text) over them. A conversation is dropped if its hash over all
its turns is the rolling hash of a longer one at the same number of turns; of equal ones that with the smallest id
stays. What is left is rendered.

Places and rolling sums are worked out in stretches of ``STRETCH`` turn numbers and then shifted by what the stretches
before them hold, so a conversation may have any number of turns. Everything is DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratum.llm.tables import stored

STRETCH = 1024
TURN_START, TURN_END = "<|im_start|>", "<|im_end|>"  # fixed values of the format
UNKNOWN_ROLE = "unknown"


def _hashes(place: Column) -> list[Column]:
    return [F.xxhash64(F.lit(seed), place, F.col("role"), F.col("text")).cast("decimal(20,0)") for seed in (1, 2)]


def rolling(conversations: DataFrame, stretch: int = STRETCH) -> DataFrame:
    """Each turn with its ``place`` (from 1), the number ``n_turns`` of its conversation, and the rolling hash ``h1, h2``.

    Turns are in order of turn number (missing ones last), role and text; a row that is there twice is one turn. A
    missing role is ``unknown``, a missing text empty. Rows without conv_id are one conversation.
    """
    last = (1 << 62) // stretch
    turns = stored(conversations.select(
        "conv_id", "turn", F.coalesce("role", F.lit(UNKNOWN_ROLE)).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(F.floor(F.col("turn") / stretch).cast("long"), F.lit(last)).alias("part")).distinct())
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("conv_id")
    parts = turns.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n")).select(
        "conv_id", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("skip"), F.sum("n").over(whole).alias("n_turns"))
    inside = Window.partitionBy("conv_id", "part").orderBy(F.col("turn").asc_nulls_last(), "role", "text")
    placed = _joined(turns, parts).withColumn("place", F.col("skip") + F.row_number().over(inside))
    one, two = _hashes(F.col("place"))
    placed = placed.withColumn("one", one).withColumn("two", two)
    sums = placed.groupBy("conv_id", "part").agg(F.sum("one").alias("one"), F.sum("two").alias("two")).select(
        "conv_id", "part", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in ("one", "two")])
    run = Window.partitionBy("conv_id", "part").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    hashes = [(F.sum(c).over(run) + F.col(f"{c}_before")).cast("decimal(38,0)").alias(name) for c, name in (("one", "h1"), ("two", "h2"))]
    return _joined(placed, sums).select("conv_id", "part", "place", "n_turns", "role", "text", *hashes)


def _joined(turns: DataFrame, parts: DataFrame) -> DataFrame:
    """Null ids meet as well."""
    parts = parts.withColumnsRenamed({"conv_id": "p_conv_id", "part": "p_part"})
    same = turns["conv_id"].eqNullSafe(parts["p_conv_id"]) & (turns["part"] == parts["p_part"])
    return turns.join(parts, same).drop("p_conv_id", "p_part")


def maximal(turns: DataFrame) -> DataFrame:
    """Of ``rolling(...)``, ``conv_id`` of each conversation that is neither part of a longer one nor a copy."""
    ends = turns.where("place = n_turns").groupBy("n_turns", "h1", "h2").agg(
        F.min("conv_id").alias("conv_id"))
    prefixes = turns.where("place < n_turns").select(F.col("place").alias("n_turns"), "h1", "h2").distinct()
    return ends.join(prefixes, ["n_turns", "h1", "h2"], "left_anti").select("conv_id")


def render(role: Column, text: Column) -> Column:
    """One turn. Marks inside the text are broken up, so a text cannot begin a turn of its own."""
    safe = lambda c: F.replace(c, F.lit("<|"), F.lit("< |"))
    return F.concat(F.lit(TURN_START), safe(role), F.lit("\n"), safe(text), F.lit(TURN_END), F.lit("\n"))


def format_conversations(conversations: DataFrame, stretch: int = STRETCH) -> DataFrame:
    """Maximal conversations of ``conversations(conv_id, turn, role, text)``: ``conv_id, part, n_turns, text``.

    One row per conversation; one of more than ``stretch`` turn numbers has a row, ``part``, for each stretch of them,
    to be read in order of ``part``. ``n_turns`` counts the turns of the row. Equal conversations are returned once,
    with the smallest id (without an id only if none has one). An empty table gives no row. Extra columns are not looked
    at.
    """
    turns = stored(rolling(conversations, stretch))
    kept = maximal(turns).withColumnRenamed("conv_id", "kept_id")
    kept = turns.join(kept, turns["conv_id"].eqNullSafe(kept["kept_id"]), "left_semi")
    lines = F.sort_array(F.collect_list(F.struct("place", render(F.col("role"), F.col("text")).alias("line"))))
    return kept.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n_turns"), lines.alias("lines")).select(
        "conv_id", "part", "n_turns", F.array_join("lines.line", "").alias("text"))
