"""Row choice per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key under ``order``.

    Written as a rank filter because Spark then cuts every map task to one row
    per key before the shuffle, so a hot key arrives as one row per task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.select("*", F.row_number().over(window).alias("_place"))
    return ranked.where(F.col("_place") <= 1).drop("_place")
