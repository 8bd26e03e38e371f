"""Tools for keys that hold a large part of all rows.

Plain aggregates combine map-side and need no help, and the adaptive engine
splits skewed sort-merge joins by itself. What remains is (a) windows, whose
groups Spark never splits, and (b) joins whose result must stay spread. Both
start from the set of hot keys, which is bounded: at most ``1/share`` keys can
each hold more than ``share`` of the rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# At most 1 / HOT_SHARE keys are hot, so the set can always be broadcast.
HOT_SHARE = 1e-5
# Groups below this many rows fit one task whatever their share is.
HOT_FLOOR = 1_000_000


# The sketch of frequent keys takes at most this many entries.
MOST_TRACKED = 1_000_000
# Tasks that merge the sketches of the scan before the last one does.
MERGERS = 64


def tracked_for(share: float) -> int:
    """Entries with which the sketch names every key of more than ``share`` of the rows.

    With a table of M entries a count is off by 3.5 / M of the rows at most, and
    a key is named if its least possible count is above that error, that is if it
    has more than 7 / M of the rows. Three quarters of the entries are filled.
    """
    return min(MOST_TRACKED, max(1024, math.ceil(0.75 * 7 / max(share, 1e-9))))


def frequent_keys(df: DataFrame, keys: Sequence[str], share: float = HOT_SHARE) -> DataFrame:
    """Exact ``_size`` of every key with more than ``share`` of the rows, and ``_total``, the rows in all.

    A sketch of frequent keys, which needs one scan and no shuffle by key, names
    the candidates; only their rows are counted. It may name rarer keys as well.
    Shares below 7 / ``MOST_TRACKED`` are not guaranteed; a key above it is never
    missed.
    """
    item = F.xxhash64(*keys)
    tracked = tracked_for(share)
    wanted = min(tracked, math.ceil(1 / max(share, 1 / tracked)))
    call = F.call_function
    # Sketches of the tasks come together in groups first, so that no task merges all of them.
    parts = df.groupBy(F.pmod(F.spark_partition_id(), F.lit(MERGERS)).alias("_part")).agg(
        F.count(F.lit(1)).alias("_n"), call("approx_top_k_accumulate", item, F.lit(tracked)).alias("_sketch")
    )
    # Grouped by a constant, as the last step can't do without a sketch, which a table without rows does not have.
    whole = parts.groupBy(F.lit(0).alias("_all")).agg(F.sum("_n").alias("_total"), call("approx_top_k_combine", F.col("_sketch"), F.lit(tracked)).alias("_sketch"))
    named = whole.select("_total", call("approx_top_k_estimate", F.col("_sketch"), F.lit(wanted)).alias("_top"))
    named = named.select("_total", F.explode("_top").alias("_one")).select("_total", F.col("_one.item").alias("_item"))
    met = df.select(*keys, item.alias("_item")).join(F.broadcast(named), "_item")
    return met.groupBy(*keys, "_total").agg(F.count(F.lit(1)).alias("_size"))


def hot_keys(
    df: DataFrame, keys: Sequence[str], share: float = HOT_SHARE, floor: int = HOT_FLOOR
) -> DataFrame:
    """Keys with more than ``share`` of the rows and more than ``floor`` rows."""
    limit = F.greatest(F.lit(float(floor)), F.col("_total") * F.lit(share))
    return frequent_keys(df, keys, share).where(F.col("_size") > limit).select(*keys)


def found_hot_keys(
    df: DataFrame, keys: Sequence[str], share: float = HOT_SHARE, floor: int = HOT_FLOOR
) -> DataFrame | None:
    """Hot keys looked up now, None if there are none.

    One job over the key columns, of which no row is shuffled but those of candidates. It pays off by keeping the plan that follows
    free of a hot path nobody needs; the list has at most ``1/share`` rows. No key
    of a table that has ``floor`` rows or fewer is hot, so that one is not searched.
    """
    total = df.count()
    if total <= floor:
        return None
    share = max(share, floor / total)
    hot = hot_keys(df, keys, share, floor)
    rows = hot.collect()
    return df.sparkSession.createDataFrame(rows, hot.schema) if rows else None


def flag_hot(df: DataFrame, hot: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add boolean ``_hot``; the hot side is broadcast because its size is bounded."""
    marked = hot.select(*[F.col(k).alias(f"_hot_{k}") for k in keys], F.lit(True).alias("_mark"))
    match = F.lit(True)
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"_hot_{k}"))
    return (
        df.join(F.broadcast(marked), match, "left")
        .withColumn("_hot", F.coalesce("_mark", F.lit(False)))
        .drop("_mark", *[f"_hot_{k}" for k in keys])
    )


def salted_join(
    facts: DataFrame,
    dimension: DataFrame,
    key: str,
    spread_by: Sequence[str],
    hot: DataFrame,
    how: str = "inner",
    salts: int = 64,
) -> DataFrame:
    """Shuffle join where only hot keys are spread over ``salts`` slots.

    Dimension rows of a hot key are copied once per slot, all other rows stay
    single, so the copying costs at most ``salts`` times the hot set.
    """
    left = flag_hot(facts, hot, [key]).withColumn(
        "_salt", F.when(F.col("_hot"), hash_slot_int(spread_by, salts)).otherwise(F.lit(0))
    )
    slots = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(
        F.array(F.lit(0))
    )
    right = flag_hot(dimension, hot, [key]).withColumn("_salt", F.explode(slots)).drop("_hot")
    return left.drop("_hot").join(right.hint("merge"), [key, "_salt"], how).drop("_salt")


def hash_slot_int(columns: Sequence[str], slots: int) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(slots)).cast("int")


def neighbour(
    df: DataFrame,
    key: str,
    order: str,
    value: Column,
    name: str,
    ahead: bool,
    hot: DataFrame | None = None,
    period: str = "day",
) -> DataFrame:
    """Add the ``value`` of the previous (or next) row of the key by ``order``.

    ``order`` is a timestamp or date, unique within a key. Without ``hot`` this
    is a lag/lead window. With it, the group of a hot key is cut into one piece
    per ``period``; each piece gets one carry row holding the value at the edge
    of the nearest non-empty piece, so no task ever holds the whole group.
    """
    shift = F.lead if ahead else F.lag
    if hot is None:
        window = Window.partitionBy(key).orderBy(order)
        return df.withColumn(name, shift(value).over(window))

    cut = F.when(F.col("_hot"), F.date_trunc(period, F.col(order)))
    rows = (
        flag_hot(df, hot, [key])
        .withColumn("_piece", cut)
        .withColumn("_value", value)
        .withColumn("_carry", F.lit(False))
    )
    edge = F.min_by if ahead else F.max_by
    along = Window.partitionBy(key).orderBy("_piece")
    # The value at an edge goes to the adjacent piece: forward for a previous
    # value, backward for a next one.
    adjacent = (F.lag if ahead else F.lead)("_piece").over(along)
    carries = (
        rows.where("_hot")
        .groupBy(key, "_piece")
        .agg(edge("_value", order).alias("_value"))
        .withColumn("_piece", adjacent)
        .where("_piece is not null")
        .withColumn("_carry", F.lit(True))
    )
    # The carry row sorts before the piece (previous) or after it (next).
    place = F.col("_carry").asc() if ahead else F.col("_carry").desc()
    within = Window.partitionBy(key, "_piece").orderBy(place, F.col(order))
    return (
        rows.unionByName(carries, allowMissingColumns=True)
        .withColumn(name, shift("_value").over(within))
        .where("not _carry")
        .drop("_hot", "_piece", "_value", "_carry")
    )
