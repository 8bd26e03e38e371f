"""What the operators of this folder share."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space of the text rules, \x20 and \x09 to \x0D.
SPACE_BYTES = b" \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def marked(value: Column) -> Column:
    """A string that tells null from every other value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def identity(*values: Column) -> Column:
    """Sixteen bytes that name a row by its values, nulls included.

    Rows that agree in all these values share an identity; the operators give
    such rows the same answer.
    """
    return F.unhex(F.md5(F.concat(*[marked(value) for value in values])))


def part_by_digest(digest: Column, parts: Column) -> Column:
    """Part of a digest among ``parts`` equal ranges of its first four bytes, in the digests' own order."""
    return F.shiftright(F.conv(F.substring(F.hex(digest), 1, 8), 16, 10).cast("long") * parts, 32).cast("int")


def free_names(frame: DataFrame, *wanted: str) -> list[str]:
    """Names for working columns that no column of the frame has."""
    taken = {name.lower() for name in frame.columns}
    if not taken.intersection(wanted):
        return list(wanted)
    mark = uuid.uuid4().hex[:8]
    return [f"{name}_{mark}" for name in wanted]


def words(text: Column) -> Column:
    """The words of a text as an array; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACES, -1), lambda word: word != "")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
