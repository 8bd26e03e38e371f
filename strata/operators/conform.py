"""Conformance: newest version per key, declared types, referential checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.columns import is_metadata
from strata.functions.windows import first_by

LOAD_COLUMNS = ("_source_system", "_source_table", "_rescued_data")


def _sortable(field: T.StructField) -> bool:
    return not isinstance(field.dataType, (T.MapType, T.VariantType))


def newest_version(df: DataFrame, key: str, order: str = "modified_at") -> DataFrame:
    """Newest row per key by ``order``, then by load time.

    Remaining columns break further ties, so the choice never depends on the
    order in which rows happen to arrive.
    """
    leading = [order] + (["_ingest_ts"] if "_ingest_ts" in df.columns else [])
    rest = [f.name for f in df.schema if f.name not in (*leading, key) and _sortable(f)]
    return first_by(df, [key], [F.col(c).desc() for c in (*leading, *rest)])


def declare(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Project to the declared columns and types plus load metadata.

    A value that does not fit its type becomes NULL; undeclared columns go.
    """
    present = set(df.columns)
    typed = [
        (F.col(name).try_cast(kind) if name in present else F.lit(None).cast(kind)).alias(name)
        for name, kind in types.items()
    ]
    carried = [c for c in df.columns if is_metadata(c) and c != "_rescued_data"]
    return df.select(*typed, *carried)


def misfits(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Rows holding a value that is present but does not fit its declared type."""
    bad = F.lit(False)
    for name, kind in types.items():
        bad = bad | (F.col(name).isNotNull() & F.col(name).try_cast(kind).isNull())
    return df.where(bad)


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Rows of ``child`` whose key no row of ``parent`` has (NULL keys included)."""
    return child.join(parent.select(key), key, "left_anti")


def orphan_count(child: DataFrame, parent: DataFrame, key: str, name: str) -> DataFrame:
    """Number of orphans, counted per key first so that a hot key is one row."""
    per_key = child.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    lost = orphans(per_key, parent, key)
    return lost.agg(F.coalesce(F.sum("_rows"), F.lit(0)).cast("bigint").alias(name))


def without_load_columns(df: DataFrame) -> DataFrame:
    return df.drop(*LOAD_COLUMNS)


def in_order(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns)
