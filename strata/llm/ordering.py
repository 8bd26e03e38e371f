"""Turns in the order of their conversations, dealt over tasks by range."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.session import settled

#: Characters of a role or text by which turns of the same number are ordered before their digest.
TIE_CHARS = 64


def tie_order(role: Column, text: Column) -> dict[str, Column]:
    """What orders turns of the same number: begin of role, begin of text, digest of both.

    The bounds of a range partitioning are samples of what it orders by, which
    the driver holds; so whole texts do not take part.
    """
    return {
        "_role": F.substring(role, 1, TIE_CHARS),
        "_text": F.substring(text, 1, TIE_CHARS),
        "_digest": F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)),
    }


def placed(rows: DataFrame, key: str, order: list[str], purpose: str) -> DataFrame:
    """The rows without ``_`` columns, written once with ``place``: ascending by key and order, nulls first.

    Within a task places have no gaps. A key with any number of rows goes over
    many tasks; rows equal in key and order take any order and are spread by chance.
    """
    kept = [name for name in rows.columns if not name.startswith("_")]
    dealt = rows.withColumn("_chance", F.rand(7)).repartitionByRange(key, *order, "_chance").sortWithinPartitions(key, *order)
    return settled(dealt.select(*kept).withColumn("place", F.monotonically_increasing_id()), purpose)
