"""Declared table schemas."""

from __future__ import annotations

from pyspark.sql import types as T

KINDS = {
    "string": T.StringType(),
    "bigint": T.LongType(),
    "timestamp": T.TimestampType(),
    "texts": T.MapType(T.StringType(), T.StringType()),
}


def columns(**kinds: str) -> T.StructType:
    """Schema from column names and the short kind names above."""
    return T.StructType([T.StructField(name, KINDS[kind]) for name, kind in kinds.items()])
