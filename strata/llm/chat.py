"""Chat formatting after the collapse of cumulative snapshots.

A log that is written after every turn holds each conversation many times, as
prefixes of its longest form. The prefix after a turn has a hash that rolls on
with the turns: a sum of turn hashes, which can be cut into blocks of turns, so
that a conversation of any length is dealt over many tasks. A conversation
whose whole hash is a proper prefix of another one goes in an anti join. Of
equal conversations the smallest id stays. What is left is rendered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.llm.shared import marked, shuffle_partitions
from strata.session import settled

#: Turn numbers of a block.
BLOCK_TURNS = 64
#: Rows of a part, at most.
PART_ROWS = 1024
#: The marks of the chat format.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def _turn_hash(seed: int) -> Column:
    content = F.xxhash64(F.lit(seed), marked(F.col("turn")), marked(F.col("role")), marked(F.col("text")))
    return content.cast("decimal(20,0)")


def _block() -> Column:
    return F.coalesce(F.floor(F.col("turn") / BLOCK_TURNS), F.lit(-(1 << 62))).cast("long")


def prefixes(conversations: DataFrame) -> DataFrame:
    """Each turn number of a conversation with block, p1, p2, n, whole, and with rows and first_part of the block.

    p1, p2 and n are hashes and length of the prefix that the turn number ends,
    ``whole`` the turns in all. Turns with the same number, or without one, belong
    to the same prefix and are added up first, so that a window has as many rows
    as a block has turn numbers, or a conversation blocks.
    """
    turns = (
        conversations.select("conv_id", "turn", "role", "text")
        .withColumns({"h1": _turn_hash(1), "h2": _turn_hash(2), "block": _block()})
        .groupBy("conv_id", "block", "turn")
        .agg(F.sum("h1").alias("h1"), F.sum("h2").alias("h2"), F.count(F.lit(1)).alias("c"))
    )
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("decimal(38,0)")
    blocks = (
        turns.groupBy("conv_id", "block")
        .agg(F.sum("h1").alias("s1"), F.sum("h2").alias("s2"), F.sum("c").alias("c"))
        .select(
            F.col("conv_id").alias("_conv"),
            F.col("block").alias("_block"),
            F.coalesce(F.sum("s1").over(before), zero).alias("b1"),
            F.coalesce(F.sum("s2").over(before), zero).alias("b2"),
            F.coalesce(F.sum("c").over(before), F.lit(0)).alias("bn"),
            F.sum("c").over(Window.partitionBy("conv_id")).alias("whole"),
            F.col("c").alias("rows"),
            F.coalesce(F.sum(F.ceil(F.col("c") / PART_ROWS)).over(before), F.lit(0)).alias("first_part"),
        )
    )
    here = Window.partitionBy("conv_id", "block").orderBy("turn").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rolled = turns.withColumns({"r1": F.sum("h1").over(here), "r2": F.sum("h2").over(here), "rn": F.sum("c").over(here)})
    return rolled.join(blocks, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("block") == F.col("_block"))).select(
        "conv_id",
        "turn",
        "block",
        (F.col("b1") + F.col("r1")).cast("decimal(38,0)").alias("p1"),
        (F.col("b2") + F.col("r2")).cast("decimal(38,0)").alias("p2"),
        (F.col("bn") + F.col("rn")).alias("n"),
        "whole",
        "rows",
        "first_part",
    )


def maximal(turns: DataFrame) -> DataFrame:
    """(conv_id, n_turns, copies) of the conversations that no other one goes on from.

    ``copies`` counts the equal ones, the kept one included. All turns without a
    conversation id are one conversation, whose id is null.
    """
    key = ["p1", "p2", "n"]
    last = turns.filter(F.col("n") == F.col("whole")).select("conv_id", *key).distinct()
    distinct = last.groupBy(*key).agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("copies"))
    # Every prefix of which at least one conversation has more.
    longer = turns.filter(F.col("n") < F.col("whole")).select(*key).distinct()
    return distinct.join(longer, key, "left_anti").select("conv_id", F.col("n").alias("n_turns"), "copies")


def _clean(value: Column) -> Column:
    """Text that can't open or close a turn by itself."""
    value = F.coalesce(value, F.lit(""))
    for mark in (OPEN, CLOSE):
        value = F.replace(value, F.lit(mark), F.lit(mark.replace("|", " | ")))
    return value


def _numbered(turns: DataFrame) -> DataFrame:
    """The turns of large blocks with ``chunk``: the parts of a block in the order of turn, role and text.

    The rows are sorted over all tasks and written with their places; a place in
    the block follows from the counts of the block in each task. Equal rows may
    take any order, a digit of chance lets them be dealt over many tasks.
    """
    spark, order = turns.sparkSession, ["conv_id", "block", "turn", "role", "text"]
    dealt = turns.withColumn("_chance", F.rand(7)).repartitionByRange(shuffle_partitions(spark), *order, "_chance").sortWithinPartitions(*order)
    placed = settled(dealt.drop("_chance").withColumns({"_place": F.monotonically_increasing_id(), "_task": F.spark_partition_id()}), "large-blocks")
    earlier = Window.partitionBy("conv_id", "block").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    runs = (
        placed.groupBy("conv_id", "block", "_task")
        .agg(F.count(F.lit(1)).alias("c"), F.min("_place").alias("_first"))
        .select(F.col("conv_id").alias("_c"), F.col("block").alias("_b"), F.col("_task").alias("_t"), "_first", F.coalesce(F.sum("c").over(earlier), F.lit(0)).alias("_earlier"))
    )
    same = F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("block") == F.col("_b")) & (F.col("_task") == F.col("_t"))
    chunk = F.floor((F.col("_earlier") + F.col("_place") - F.col("_first")) / PART_ROWS)
    return placed.join(runs, same).select(*turns.columns, chunk.cast("long").alias("chunk"))


def rendered(conversations: DataFrame) -> DataFrame:
    """(conv_id, n_turns, copies, part, rendered): maximal conversations as chat text.

    A conversation has a row for each block of 64 turn numbers that it uses, and
    for every ``PART_ROWS`` turns of a block that has more, ``part`` counting from
    0; its parts in order are its text. A missing role is empty, as is a missing
    text; marks inside of texts are written with spaces. Turns of the same number
    are ordered by role and text. No conversations give no rows, other columns are
    not looked at.
    """
    by_number = settled(prefixes(conversations), "turn-prefixes")
    kept = maximal(by_number).withColumnRenamed("conv_id", "_conv")
    blocks = by_number.select("conv_id", "block", "rows", "first_part").distinct().join(kept, F.col("conv_id").eqNullSafe(F.col("_conv")))
    blocks = settled(blocks.select(F.col("conv_id").alias("_conv"), F.col("block").alias("_block"), "n_turns", "copies", "rows", "first_part"), "kept-blocks")
    turns = conversations.select("conv_id", "turn", "role", "text", _block().alias("block"))
    own = ["conv_id", "n_turns", "copies", "block", "first_part", "turn", "role", "text"]
    of = lambda some: turns.join(some, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("block") == F.col("_block"))).select(*own)
    rows = of(blocks.filter(F.col("rows") <= PART_ROWS)).withColumn("chunk", F.lit(0).cast("long"))
    large = blocks.filter(F.col("rows") > PART_ROWS)
    if not large.isEmpty():
        rows = rows.unionByName(_numbered(of(large)))
    parts = (
        rows.groupBy("conv_id", "n_turns", "copies", (F.col("first_part") + F.col("chunk")).cast("int").alias("part"))
        .agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    )
    line = lambda turn: F.concat(F.lit(OPEN), _clean(turn["role"]), F.lit("\n"), _clean(turn["text"]), F.lit(CLOSE + "\n"))
    return parts.select("conv_id", "n_turns", "copies", "part", F.array_join(F.transform("turns", line), "").alias("rendered"))
