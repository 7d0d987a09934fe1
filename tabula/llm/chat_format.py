"""Chat formatting by perspective rotation.

A conversation is rendered once for each of its participants: the participant's turns are
the assistant's, every other speaker is a user under their own name, and system turns stay
system turns. The mask marks what the assistant says (its text and end mark), as ranges of
the rendered text.

The rows of a conversation are numbered by (turn, speaker, text), null turns first, and rendered
in blocks of ``BLOCK_TURNS`` consecutive ones. The numbering spreads a large conversation over
tasks, so one of any length is in many blocks, whatever its turns are called; the blocks of one
perspective, joined in order, are the whole rendering, and ``block_start`` is where a block begins
in it. Text that looks like a mark is broken by a blank. A null speaker is ``unknown``, a null text
empty; repeated rows are repeated. A conversation without participants gives no rows. A null conversation
id is an id like any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabula.operators.sequence import sequence_within

BLOCK_TURNS = 256
SYSTEM = "system"
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def _plain(text: Column) -> Column:
    return F.replace(text, F.lit("<|"), F.lit("< |"))


def rotate(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", speaker_col: str = "role",
           text_col: str = "text", block_turns: int = BLOCK_TURNS) -> DataFrame:
    """(conv_id, perspective, block, block_start, n_turns, rendered, mask array of (start, end))."""
    name = F.regexp_replace(_plain(F.coalesce(F.col(f"`{speaker_col}`").cast("string"), F.lit("unknown"))), r"[\r\n]+", " ")
    turns = df.select(
        F.col(f"`{conv_col}`").alias("conv_id"), F.col(f"`{turn_col}`").cast("long").alias("turn"), name.alias("speaker"),
        _plain(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))).alias("said"),
    )
    turns = sequence_within(turns, ["conv_id"], ["turn", "speaker", "said"], out="place")
    turns = turns.withColumn("block", F.floor((F.col("place") - 1) / F.lit(block_turns)).cast("long"))
    # two aggregates of the same turns: who speaks (small, combined map-side) and the turns of a block
    people = turns.where(F.col("speaker") != SYSTEM).groupBy("conv_id").agg(
        F.sort_array(F.collect_set("speaker")).alias("people")
    )
    blocks = turns.groupBy("conv_id", "block").agg(
        F.sort_array(F.collect_list(F.struct("place", "turn", "speaker", "said"))).alias("turns")
    )
    b, p = blocks.alias("b"), people.alias("p")
    rows = b.join(p, F.col("b.conv_id").eqNullSafe(F.col("p.conv_id"))).select(
        "b.conv_id", "block", "turns", F.explode("people").alias("perspective")
    )

    def part(t: Column) -> Column:
        own = t["speaker"] == F.col("perspective")
        who = F.when(own, F.lit("assistant")).when(t["speaker"] == SYSTEM, F.lit(SYSTEM)).otherwise(
            F.concat(F.lit("user name="), t["speaker"])
        )
        head = F.concat(F.lit(OPEN), who, F.lit("\n"))
        return F.struct(own.alias("own"), F.length(head).alias("head"), F.concat(head, t["said"], F.lit(CLOSE + "\n")).alias("all"))

    rows = rows.select("conv_id", "perspective", "block", F.transform("turns", part).alias("parts"))
    mask = F.expr(
        "aggregate(parts, struct(0 as at, cast(array() as array<struct<start:int,end:int>>) as mask), (a, p) -> struct("
        "a.at + length(p.all) as at, if(p.own, array_append(a.mask, named_struct('start', a.at + p.head, 'end', a.at + length(p.all) - 1)), a.mask) as mask), "
        "a -> a.mask)"
    )
    rows = rows.select(
        "conv_id", "perspective", "block", F.size("parts").cast("long").alias("n_turns"),
        F.array_join(F.transform("parts", lambda x: x["all"]), "").alias("rendered"), mask.alias("mask"),
    )
    # a row per block: the turns of one conversation divided by the block's length
    before = Window.partitionBy("conv_id", "perspective").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    start = F.coalesce(F.sum(F.length("rendered")).over(before), F.lit(0)).cast("long")
    return rows.select("conv_id", "perspective", "block", start.alias("block_start"), "n_turns", "rendered", "mask")


def report(df: DataFrame) -> DataFrame:
    """``rotate`` with the mask as text (start:end, comma-joined)."""
    spans = F.transform("mask", lambda s: F.concat_ws(":", s["start"], s["end"]))
    return rotate(df).withColumn("mask", F.array_join(spans, ","))
