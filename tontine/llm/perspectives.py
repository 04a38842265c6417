"""Chat formatting: multi-party perspective rotation.

For every participant of a conversation the whole dialogue is rendered with that
speaker as the assistant, every other speaker as a named user and system turns as
they are; only the assistant's words and the end mark after them are trained on.

The result has one row a message of a rendering, with its place in it: the
messages of one (conversation, perspective) in order of ``seq``, joined without
anything between, are the rendering, and the trained spans are its mask.  So no
conversation is ever gathered into one value, whatever its length; ``rendered``
does that for those who want whole texts.  Turns are numbered, and the places of
messages summed, by range-partitioned scans, so a conversation that holds a third of
all turns (or all turns without one) is spread over many tasks.

Turns are ordered by ``turn``, then speaker and text (nulls last).  Results for odd
input: a turn without a speaker is a user without a name and no perspective of its
own; null text counts as empty; repeated turns are messages of their own; turns
whose conversation is null are one conversation; a conversation of system turns
alone has no perspective and so no row; texts of any length are rendered whole; other
columns are not looked at, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tontine.llm.graph import dealt
from tontine.operators.scan import ordered_scan

SYSTEM = "system"
BEGIN, END = "<|im_start|>", "<|im_end|>\n"


def rotate(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", speaker_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """One row a message of each perspective: ``conv_id``, ``perspective``, ``seq`` (from 0), ``turn``,
    ``role``, ``name``, ``message`` (as rendered), ``start`` and ``end`` in the rendering, ``train_start`` and
    ``train_end`` of the trained characters (null if none); positions are code points."""
    given = turns.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), F.col(speaker_col).alias("speaker"),
                         F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    order = [F.col(c).asc_nulls_last() for c in ("turn", "speaker", "text")]
    numbered = ordered_scan(given, ["conv_id"], order).withColumn("seq", F.col("_pos") - 1).drop("_pos", "_n")
    people = (given.filter(F.col("speaker").isNotNull() & (F.col("speaker") != SYSTEM))
              .select(F.col("conv_id").alias("of"), F.col("speaker").alias("perspective")).distinct())
    role = (F.when(F.col("speaker") == F.col("perspective"), "assistant").when(F.col("speaker") == SYSTEM, SYSTEM).otherwise("user"))
    head = F.concat(F.lit(BEGIN), "role", F.coalesce(F.concat(F.lit(" name="), "name"), F.lit("")), F.lit("\n"))
    said = (numbered.join(dealt(people), F.col("conv_id").eqNullSafe(F.col("of"))).drop("of")
              .withColumn("role", role).withColumn("name", F.when(F.col("role") == "user", F.col("speaker")))
              .withColumn("head", head).withColumn("message", F.concat("head", "text", F.lit(END)))
              .withColumn("size", F.length("message").cast("long")).drop("text"))
    placed = (ordered_scan(said, ["conv_id", "perspective"], ["seq"], sums=["size"])
              .withColumn("start", (F.col("size__cum") - F.col("size")).cast("long")))
    trained = F.col("role") == "assistant"
    end = F.col("start") + F.length("message")
    return placed.select("conv_id", "perspective", F.col("seq").cast("long").alias("seq"), "turn", "role", "name", "message", "start",
                         end.alias("end"), F.when(trained, F.col("start") + F.length("head")).alias("train_start"),
                         F.when(trained, end).alias("train_end"))


def rendered(rotated: DataFrame) -> DataFrame:
    """Whole renderings for conversations that fit in one value: ``text`` and ``mask`` (spans trained on)."""
    rows = F.array_sort(F.collect_list(F.struct("seq", "message", "train_start", "train_end")))
    return (rotated.groupBy("conv_id", "perspective").agg(rows.alias("rows"))
            .select("conv_id", "perspective", F.array_join(F.col("rows.message"), "").alias("text"),
                    F.transform(F.filter("rows", lambda r: r["train_start"].isNotNull()),
                                lambda r: F.struct(r["train_start"].alias("start"), r["train_end"].alias("end"))).alias("mask")))
