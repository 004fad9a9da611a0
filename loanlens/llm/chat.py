"""Chat formatting by multi-party perspective rotation.

Every participant of a conversation gets the whole dialogue rendered from its side: its own
turns as assistant, all others as named users, and loss spans over what the assistant says.
Roles in ``narrators`` (system text) are rendered as what they are and take no side.

    <|im_start|>user name=ann\\nHello<|im_end|>\\n
    <|im_start|>assistant\\nHi<|im_end|>\\n

A dialogue of any length is rendered in parts of at most ``part_turns`` turns, so that no task
holds a whole conversation; the parts of one perspective, joined in order, are the rendering,
and ``first_char`` is where a part begins in it, summed up from the parts' lengths alone.  Spans are code points within the part: from the
first character said to the end of the end mark.

Defined results: turns go by (turn, role, text), null turns last; rows that repeat a conversation's
turn, role and text count once; a null role speaks as "unknown"; a null text is empty; rows with
a null conv_id form one conversation; a conversation with narrators alone has no perspective and
gives no row; an empty table gives an empty result.  Turns with a null or one equal number are ordered together in
one task.  Only conv_id, turn, role and text are read, so other columns may have any name.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loanlens.llm.state import cut


@dataclass(frozen=True)
class Settings:
    narrators: tuple[str, ...] = ("system",)
    part_turns: int = 64
    begin: str = "<|im_start|>"
    end: str = "<|im_end|>"


def render(conversations: DataFrame, s: Settings = Settings()) -> DataFrame:
    """conv_id, speaker, part, n_turns, first_char, text, loss_spans ("from-to,...") for every part of every perspective."""
    turns = conversations.select(
        "conv_id", "turn", F.coalesce("role", F.lit("unknown")).alias("role"),
        F.coalesce("text", F.lit("")).alias("said")).distinct()
    # turns of one stretch of numbers are numbered together: a long dialogue is not sorted in one task
    turns = turns.withColumn("stretch", F.floor(F.col("turn") / s.part_turns))
    order = Window.partitionBy("conv_id", "stretch").orderBy(F.col("turn").asc_nulls_last(), "role", "said")
    turns = turns.withColumn("nth", F.row_number().over(order) - 1).withColumn(
        "slice", F.floor(F.col("nth") / s.part_turns))

    speakers = turns.where(~F.col("role").isin(*s.narrators)).select(
        F.col("conv_id").alias("of_conv"), F.col("role").alias("speaker")).distinct()
    sides = turns.join(speakers, F.col("conv_id").eqNullSafe(F.col("of_conv")))
    own = F.col("role") == F.col("speaker")
    header = F.when(own, F.lit("assistant")).when(F.col("role").isin(*s.narrators), F.col("role")).otherwise(
        F.concat(F.lit("user name="), F.col("role")))
    head = F.concat(F.lit(s.begin), header, F.lit("\n"))
    piece = F.struct("nth", F.concat(head, "said", F.lit(s.end + "\n")).alias("piece"), F.length(head).alias("head"), own.alias("own"))
    parts = (sides.groupBy("conv_id", "speaker", "stretch", "slice")
             .agg(F.array_sort(F.collect_list(piece)).alias("pieces")))  # at most part_turns
    before = lambda i: F.aggregate(F.slice("pieces", F.lit(1), i), F.lit(0), lambda n, p: n + F.length(p["piece"]))
    spans = F.filter(F.transform("pieces", lambda p, i: F.when(p["own"], F.concat(
        (before(i) + p["head"]).cast("string"), F.lit("-"), (before(i) + F.length(p["piece"]) - 1).cast("string")))),
        lambda x: x.isNotNull())
    parts = parts.select("conv_id", "speaker", "stretch", "slice", F.size("pieces").alias("n_turns"),
                         F.array_join(F.transform("pieces", lambda p: p["piece"]), "").alias("text"),
                         F.array_join(spans, ",").alias("loss_spans"))
    parts = cut(parts)
    along = Window.partitionBy("conv_id", "speaker").orderBy(F.col("stretch").asc_nulls_last(), "slice")
    places = (parts.select("conv_id", "speaker", "stretch", "slice", F.length("text").cast("long").alias("size"))
              .withColumn("part", (F.row_number().over(along) - 1).cast("int"))
              .withColumn("first_char", F.coalesce(F.sum("size").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("size"))
    keys = ["conv_id", "speaker", "stretch", "slice"]
    named = places.select(*(F.col(c).alias(f"at_{c}") for c in keys), "part", "first_char")
    same = reduce(and_, (F.col(c).eqNullSafe(F.col(f"at_{c}")) for c in keys))
    return parts.join(named, same).select("conv_id", "speaker", "part", "n_turns", "first_char", "text", "loss_spans")
