"""Dialogues from the point of view of each participant (operator 4).

For every participant of a conversation the dialogue is rendered once with that speaker as
the assistant and all others as named users. Only the speaker's own turns are trained on.
A rendering is cut into parts of ``PART_TURNS`` turns, numbered in order; the parts of one
perspective put together are the whole dialogue. ``mask_start`` and ``mask_end`` list the
spans of characters of a part that are trained on: the texts of the speaker and the mark that
ends them.

Turns are ordered by (turn, role, text), nulls last, and numbered from 0 without gaps. The
number is a rank in a block of turns plus the sizes of the blocks before, so a conversation
may be of any length. Only DataFrame functions are used.

Defined cases: a null text is empty; a null or empty role is the participant ``unknown``; a
row without a conversation id is a dialogue of one turn. Rows that are equal in conversation,
turn (or lack of one), speaker and text are turns like others, one after the other; they are
counted first, so that any number of them is no burden, and unfolded when they have their
places. Participants that say nothing but empty texts count.
Markers inside texts and names are kept as they are, but line ends in a name become spaces.
An empty table gives an empty one; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PART_TURNS = 32
BLOCK_TURNS = 32
PIECE = 4096
# fixed values: the chat template
BEGIN, END = "<|im_start|>", "<|im_end|>"


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """Rows (dialogue, conv_id, turn, speaker, body, position); dialogue tells conversations
    apart, also those without an id."""
    name = F.regexp_replace(F.coalesce("role", F.lit("")), "[\r\n]+", " ")
    turns = (conversations.select(
        "conv_id", "turn", F.when(name == "", "unknown").otherwise(name).alias("speaker"),
        F.coalesce("text", F.lit("")).alias("body"))
        .groupBy("conv_id", "turn", "speaker", "body").agg(F.count("*").alias("times")))
    content = F.md5(F.concat_ws("\n", "speaker", "body"))
    turns = turns.withColumns({
        "dialogue": F.coalesce(F.concat(F.lit("c"), "conv_id"), F.concat(
            F.lit("r"), F.coalesce(F.col("turn").cast("string"), F.lit("")), F.lit(" "), content)),
        "block": F.coalesce(F.floor(F.col("turn") / BLOCK_TURNS), F.lit(2 ** 62)),
        # rows without a turn have blocks by their content: there may be any number of them
        "sub": F.when(F.col("turn").isNull(), F.substring(content, 1, 3)).otherwise("")})
    block = ["dialogue", "block", "sub"]
    inside = (Window.partitionBy(*block).orderBy(F.asc_nulls_last("turn"), "speaker", "body")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    before = Window.partitionBy("dialogue").orderBy("block", "sub")
    sizes = turns.groupBy(*block).agg(F.sum("times").alias("size"))
    sizes = sizes.withColumn("before", F.sum("size").over(before) - F.col("size")).drop("size")
    placed = (turns.withColumn("inside", F.sum("times").over(inside) - F.col("times"))
              .join(sizes, block))
    # in two steps, so that no array grows with the number of equal turns
    pieces = placed.withColumn("piece", F.explode(F.sequence(
        F.lit(0), F.floor((F.col("times") - 1) / PIECE))))
    last = F.least(F.col("times") - 1, F.col("piece") * PIECE + (PIECE - 1))
    copies = pieces.withColumn("copy", F.explode(F.sequence(F.col("piece") * PIECE, last)))
    alone = F.col("conv_id").isNull()
    return copies.select(
        F.when(alone, F.concat("dialogue", F.lit("#"), F.col("copy").cast("string")))
        .otherwise(F.col("dialogue")).alias("dialogue"), "conv_id", "turn", "speaker", "body",
        F.when(alone, F.lit(0)).otherwise(F.col("inside") + F.col("before") + F.col("copy"))
        .alias("position"))


def rotate(conversations: DataFrame, part_turns: int = PART_TURNS) -> DataFrame:
    """Rows (conv_id, perspective, part, n_turns, n_trained, rendered, mask_start, mask_end)."""
    turns = numbered_turns(conversations)
    people = turns.select("dialogue", F.col("speaker").alias("perspective")).distinct()
    own = F.col("speaker") == F.col("perspective")
    head = F.concat(F.lit(BEGIN), F.when(own, F.lit("assistant")).otherwise(
        F.concat(F.lit("user name="), "speaker")), F.lit("\n"))
    trained = F.concat("body", F.lit(END))
    seen = (turns.join(people, "dialogue")
            .withColumns({"part": F.floor(F.col("position") / part_turns), "head": head,
                          "own": own})
            .select("dialogue", "conv_id", "perspective", "part", "position", "own", "head", "body"))
    # at most part_turns rows in a group, for positions have no ties
    parts = seen.groupBy("dialogue", "conv_id", "perspective", "part").agg(F.array_sort(F.collect_list(F.struct(
        "position", "own", F.char_length("head").alias("before"),
        F.concat("head", trained, F.lit("\n")).alias("segment")))).alias("turns"))
    spans = F.aggregate(
        "turns", F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<s:int,e:int>>").alias("spans")),
        lambda acc, t: F.struct(
            (acc["at"] + F.char_length(t["segment"])).alias("at"),
            F.when(t["own"], F.concat(acc["spans"], F.array(F.struct(
                (acc["at"] + t["before"]).alias("s"),
                (acc["at"] + F.char_length(t["segment"]) - 1).alias("e")))))
            .otherwise(acc["spans"]).alias("spans")),
        lambda acc: acc["spans"])
    return (parts.withColumn("spans", spans)
            .select("conv_id", "perspective", "part", F.size("turns").alias("n_turns"),
                    F.size("spans").alias("n_trained"),
                    F.array_join(F.transform("turns", lambda t: t["segment"]), "").alias("rendered"),
                    F.col("spans.s").alias("mask_start"), F.col("spans.e").alias("mask_end")))
