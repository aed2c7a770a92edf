"""Multi-party perspective rotation: every dialogue once per participant, with that speaker as the assistant.

The other participants are users with their names, context roles stay what they are, and a mask marks the characters of
the assistant's turns. Long dialogues are rendered in segments, so that a row stays small however long a dialogue is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.operators.order_stats import ordered_counts
from shelfcast.session import materialise

END = "<|end|>\n"
UNNAMED = "unknown"


def _plain(text: Column) -> Column:
    """A text in which no mark-up can begin: ``<|`` becomes ``<\\|``."""
    return F.replace(text, F.lit("<|"), F.lit("<\\|"))


def rotate(
    turns: DataFrame,
    segment_turns: int = 64,
    context: tuple[str, ...] = ("system",),
    conversation: str = "conv_id",
    turn: str = "turn",
    speaker: str = "role",
    text: str = "text",
) -> DataFrame:
    """One row per conversation, segment and participant.

    ``conv_id, segment, sub_segment, assistant`` (the participant), ``n_turns, n_masked`` (turns of the segment, and those by
    the participant), ``text`` (rendered) and ``mask`` (array of start and end, in code points, of what the participant says, closing mark included).

    A participant is any speaker of a conversation outside ``context``; a null or empty speaker is called ``unknown``. Turns are ordered by
    turn number, null first, and where numbers are equal by a hash of speaker and text. Repeated rows (equal in all four columns)
    are one turn. Rows with a null conversation are one conversation with a null id. A null text is empty. ``segment`` counts in steps of
    ``segment_turns`` turns; a turn number that is shared by more turns than that has segments of its own, told apart by ``sub_segment``.
    Texts of any length are rendered whole. A participant who says nothing in a segment has a row there with an empty mask. A conversation of
    context turns alone has no participant and no row; an empty table gives none; other columns are left out.

    Places of turns come from range-partitioned running counts and at most about twice ``segment_turns`` turns are brought together, so
    no conversation has to fit in one task.
    """
    rows = turns.select(
        F.col(f"`{conversation}`").alias("conv_id"),
        F.coalesce(F.concat(F.lit("="), F.col(f"`{conversation}`").cast("string")), F.lit("")).alias("conv"),
        F.coalesce(F.col(f"`{turn}`").cast("long"), F.lit(-(1 << 63)).cast("long")).alias("at"),
        F.coalesce(F.when(F.col(f"`{speaker}`") != "", F.col(f"`{speaker}`")), F.lit(UNNAMED)).alias("who"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("said"),
    )
    once = rows.groupBy("conv_id", "conv", "at", "who", "said").agg(F.lit(1).alias("one")).drop("one")
    once = materialise(once.withColumn("tie", F.xxhash64("who", "said")), "turns").df
    places = ordered_counts(once, ["conv"], "at").select("conv", "at", F.col("_n").alias("here"), F.col("_before").alias("before"))
    own = F.col("here") > segment_turns
    parts = F.ceil(F.col("here") / segment_turns)
    # The tie order is that of the hash, so equal stretches of hash values are consecutive turns.
    stretch = F.floor((F.col("tie") / F.lit(2.0**64) + 0.5) * parts).cast("long")
    placed = once.join(places, ["conv", "at"]).withColumns(
        {
            "segment": F.floor(F.col("before") / segment_turns).cast("long"),
            "lone": F.when(own, F.col("at")),
            "sub_segment": F.when(own, 1 + F.least(stretch, parts - 1)).otherwise(0).cast("long"),
        }
    )
    pieces = placed.groupBy("conv", "segment", "lone", "sub_segment").agg(
        F.first("conv_id").alias("conv_id"), F.array_sort(F.collect_list(F.struct("at", "tie", "who", "said"))).alias("turns")
    )
    each = once.filter(~F.col("who").isin(*context)).select("conv", F.col("who").alias("assistant")).distinct()
    return pieces.join(each, "conv").select(
        "conv_id",
        "segment",
        "sub_segment",
        "assistant",
        F.size("turns").cast("long").alias("n_turns"),
        F.size(F.filter("turns", lambda t: t["who"] == F.col("assistant"))).cast("long").alias("n_masked"),
        *_rendered(context),
    )


def _rendered(context: tuple[str, ...]) -> list[Column]:
    def head(t: Column) -> Column:
        return (
            F.when(t["who"] == F.col("assistant"), F.lit("<|assistant|>\n"))
            .when(t["who"].isin(*context), F.concat(F.lit("<|"), t["who"], F.lit("|>\n")))
            .otherwise(F.concat(F.lit("<|user name="), F.replace(_plain(t["who"]), F.lit("|>"), F.lit("\\|>")), F.lit("|>\n")))
        )

    def sizes(t: Column) -> Column:
        body = F.length(_plain(t["said"])) + len(END)
        return F.struct(F.length(head(t)).alias("head"), body.alias("body"), (t["who"] == F.col("assistant")).alias("own"))

    text = F.array_join(F.transform("turns", lambda t: F.concat(head(t), _plain(t["said"]), F.lit(END))), "")
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def walk(done: Column, s: Column) -> Column:
        begin = done["at"] + s["head"]
        end = begin + s["body"]
        span = F.struct(begin.alias("start"), end.alias("end"))
        return F.struct(end.alias("at"), F.when(s["own"], F.concat(done["spans"], F.array(span))).otherwise(done["spans"]).alias("spans"))

    mask = F.aggregate(F.transform("turns", sizes), start, walk, lambda done: done["spans"])
    return [text.alias("text"), mask.alias("mask")]


def mask_text(mask: str = "mask") -> Column:
    """A mask as ``start-end`` pairs joined by commas."""
    return F.array_join(F.transform(mask, lambda s: F.concat(s["start"].cast("string"), F.lit("-"), s["end"].cast("string"))), ",")
