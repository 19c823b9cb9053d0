"""Chat formatting by cumulative-snapshot collapse (DataFrame functions only).

Chat logs hold the same conversation again and again, each time with a few more
turns. A snapshot whose turns are a proper prefix of a longer conversation, and
each further copy of the same conversation, carries nothing new. Every turn gets
a rolling hash of the conversation up to it: the position-tagged hashes of the
turns so far, combined by xor. A conversation whose last hash occurs as the hash
of a proper prefix elsewhere is dropped by an anti-join; what remains is rendered.

No conversation is ever gathered whole for hashing: running xors and turn
numbers are taken inside blocks of turns and carried over the blocks' totals.
The rendering has one row per part of ``part_turns`` turns, so a conversation
with very many turns needs no large value either (ordinary ones are one part).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stage

START, END = "<|im_start|>", "<|im_end|>"
BLOCK_SHIFT = 8   # turn numbers in blocks of 256


def _hashes(*cols):
    """Two independent 60-bit halves of one SHA-256 (they fit a signed long)."""
    digest = F.sha2(F.concat(*cols), 256)
    return [F.conv(F.substring(digest, at, 15), 16, 10).cast("long") for at in (1, 16)]


def turn_prefixes(conversations: DataFrame) -> DataFrame:
    """One row per turn: conv_id, pos (from 0), role, text, h1, h2 (hash of the
    turns up to this one) and n_turns.

    Rows without conv_id belong to no conversation and are left out. Equal
    (conv_id, turn, role, text) rows are replays of one turn. Turns are ordered
    by (turn, role, text), nulls first; a null role or text differs from an
    empty one and is rendered as empty."""
    t = conversations.select("conv_id", "turn", "role", "text").where(F.col("conv_id").isNotNull()).distinct()
    t = t.withColumn("_b", F.shiftright(F.coalesce(F.col("turn").cast("long"), F.lit(-(2**63))), BLOCK_SHIFT))
    inside = Window.partitionBy("conv_id", "_b").orderBy("turn", "role", "text")
    blocks = t.groupBy("conv_id", "_b").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("conv_id").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("conv_id")
    base = blocks.select("conv_id", "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"),
                         F.sum("_n").over(whole).alias("n_turns"))
    t = t.withColumn("_row", F.row_number().over(inside)).join(base, ["conv_id", "_b"]) \
        .withColumn("pos", F.col("_base") + F.col("_row") - 1)
    tag = lambda c: F.when(F.col(c).isNull(), F.lit("-")).otherwise(F.concat(F.length(c).cast("string"), F.lit(":"), F.col(c)))
    g1, g2 = _hashes(F.col("pos").cast("string"), F.lit("|"), tag("role"), F.lit("|"), tag("text"))
    t = t.withColumns({"_g1": g1, "_g2": g2})
    rolled = Window.partitionBy("conv_id", "_b").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    carry = t.groupBy("conv_id", "_b").agg(F.bit_xor("_g1").alias("_x1"), F.bit_xor("_g2").alias("_x2")) \
        .select("conv_id", "_b", *[F.coalesce(F.bit_xor(f"_x{i}").over(before), F.lit(0)).alias(f"_c{i}") for i in (1, 2)])
    t = t.withColumns({f"_r{i}": F.bit_xor(f"_g{i}").over(rolled) for i in (1, 2)}).join(carry, ["conv_id", "_b"])
    return t.select("conv_id", "pos", "role", "text", "n_turns",
                    *[F.col(f"_r{i}").bitwiseXOR(F.col(f"_c{i}")).alias(f"h{i}") for i in (1, 2)])


def maximal_conversations(turns: DataFrame) -> DataFrame:
    """conv_id, n_turns, n_copies of the conversations that are no proper prefix
    of another; of equal ones the smallest conv_id stands for all."""
    last = turns.where(F.col("pos") == F.col("n_turns") - 1)
    whole = last.groupBy("h1", "h2", "n_turns").agg(F.min("conv_id").alias("conv_id"),
                                                    F.count(F.lit(1)).alias("n_copies"))
    proper = turns.where(F.col("pos") < F.col("n_turns") - 1).select("h1", "h2", (F.col("pos") + 1).alias("n_turns")).distinct()
    return whole.join(proper, ["h1", "h2", "n_turns"], "left_anti").select("conv_id", "n_turns", "n_copies")


def render(turns: DataFrame, kept: DataFrame, part_turns: int = 256) -> DataFrame:
    """conv_id, part, n_turns, n_copies, text, n_chars and spans (start, end of
    what the assistant says, in code points of the part's text). Control markers inside a turn's own
    text lose their ``|`` so that they cannot open or close a turn."""
    clean = lambda c: F.regexp_replace(F.coalesce(c, F.lit("")), r"<\|(im_start|im_end)\|>", "<$1>")
    t = turns.join(kept.select("conv_id", "n_copies"), "conv_id")
    head = F.concat(F.lit(START), clean("role"), F.lit("\n"))
    t = t.select("conv_id", F.floor(F.col("pos") / part_turns).alias("part"), "pos", "n_turns", "n_copies", "role",
                 head.alias("head"), clean("text").alias("body"))
    t = t.withColumn("seg", F.concat("head", "body", F.lit(END + "\n")))
    in_part = Window.partitionBy("conv_id", "part").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    t = t.withColumn("at", F.coalesce(F.sum(F.length("seg")).over(in_part), F.lit(0)) + F.length("head"))
    span = F.when(F.col("role") == "assistant", F.struct(F.col("at").alias("start"), (F.col("at") + F.length("body")).alias("end")))
    out = t.groupBy("conv_id", "part").agg(
        F.max("n_turns").alias("n_turns"), F.max("n_copies").alias("n_copies"),
        F.array_sort(F.collect_list(F.struct("pos", "seg"))).alias("_segs"),
        F.array_sort(F.collect_list(span)).alias("spans"))
    return out.withColumn("text", F.array_join(F.col("_segs.seg"), "")) \
        .select("conv_id", "part", "n_turns", "n_copies", "text", F.length("text").alias("n_chars"), "spans")


def format_chats(conversations: DataFrame, part_turns: int = 256) -> DataFrame:
    """Maximal conversations, rendered. No rows in, no rows out; other columns
    of the input play no part."""
    turns = stage(turn_prefixes(conversations), "chat-turns")
    return render(turns, maximal_conversations(turns), part_turns)
